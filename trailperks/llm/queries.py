"""The registered queries of the operators, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trailperks.llm import (
    bpe, language, language_model, merkle, packing, periodic, pii, simhash, substrings, suffix_dedup, topk, url_filters, weighted_sampling,
)
from trailperks.llm.common import id_remainder, table
from trailperks.llm.registry import query

URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

URL_SQL = r"""
WITH rules(verdict, host, path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
split AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
located AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM split)
SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, coalesce(r.verdict, 'allow') AS verdict
FROM located p LEFT JOIN rules r
  ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
QUALIFY row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) = 1
"""


@query("op6_url_filters", URL_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    judged = url_filters.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(
    [x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
FROM scored QUALIFY rank <= 5
"""


@query("op8_exact_topk", TOPK_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.search(vectors, k=5, query_modulus=50, scale=256)


@query("op1_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, capacity=2048)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder(F.col("doc_id"), 3) == 1
    model = language.fit(docs, ~held_out)
    judged = language.identify(docs.select("doc_id", "text"), model)
    return judged.select("row.doc_id", id_remainder(F.col("row.doc_id"), 3).alias("r"), "lang_pred", "score").select(
        "doc_id", (F.col("r") == 1).alias("held_out"), "lang_pred", "score"
    )


@query("op4_simhash_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, shingle=3, max_bits=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


REPEATED_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
spans AS (
  SELECT doc_id, s, array_to_string(words[s : s + 19], ' ') AS k
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 19)) AS s FROM texts WHERE len(words) >= 20)),
firsts AS (SELECT k, min(struct_pack(d := doc_id, s := s)) AS f FROM spans GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(spans.s, spans.s + 19)) AS p
  FROM spans JOIN firsts USING (k) WHERE struct_pack(d := doc_id, s := spans.s) > f),
placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS p FROM texts),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS rest, count(*) AS n
  FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(rest, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""


@query("op10_substring_dedup", REPEATED_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substrings.remove_repeated(docs, window=20)
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


@query("op3_pii")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.protect(docs)

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "term")
    counts = [number(kind) for kind in ("email", "ip", "card", "phone")]
    return found.select(
        "row.doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )


@query("op9_weighted_sampling")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op7_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return bpe.decode(encoded.select("row.doc_id", "ids"), path).select(
        F.col("row.doc_id").alias("doc_id"),
        F.floor(F.octet_length("row.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("row.ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op5_language_model")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_remainder(F.col("doc_id"), 7) == 2
    scored = language_model.score(docs, ~held_out)
    return scored.select(
        F.col("row.doc_id").alias("doc_id"),
        (id_remainder(F.col("row.doc_id"), 7) == 2).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )


#: CRC-32 of the decimal digits of an id, bit by bit.
CRC32_SQL = """
crc(doc_id, crc) AS (
  SELECT doc_id, xor(4294967295, list_reduce(list_prepend(4294967295, [ord(c) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
    lambda a, byte: list_reduce(list_prepend(xor(a, byte), [CAST(b AS BIGINT) FOR b IN range(8)]),
      lambda x, b: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))
  FROM documents)
"""

MANIFEST_SQL = f"""
WITH RECURSIVE {CRC32_SQL.strip()},
written AS (
  SELECT doc_id, lang, crc % 7 = 0 AS tampered,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS chars,
    coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') AS other_chars,
    coalesce(strlen(text) || ':' || text, '-') AS body
  FROM documents JOIN crc USING (doc_id)),
leaves AS (
  SELECT doc_id, lang, sha256(head || chars || body) AS leaf,
    sha256(head || CASE WHEN tampered THEN other_chars ELSE chars END || body) AS shown,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place
  FROM written),
inner_nodes(lang, level, place, node, held) AS (
  SELECT lang, 0, place, leaf, count(*) OVER (PARTITION BY lang) FROM leaves
  UNION ALL
  SELECT lang, level + 1, place, sha256(string_agg(node, '' ORDER BY below)), any_value((held + 1) // 2)
  FROM (SELECT lang, level, place // 2 AS place, place AS below, node, held FROM inner_nodes WHERE held > 1)
  GROUP BY lang, level, place),
subroots AS (
  SELECT lang, level AS height, node AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS place
  FROM inner_nodes WHERE held = 1),
outer_nodes(level, place, node, held) AS (
  SELECT 0, place, subroot, count(*) OVER () FROM subroots
  UNION ALL
  SELECT level + 1, place, sha256(string_agg(node, '' ORDER BY below)), any_value((held + 1) // 2)
  FROM (SELECT level, place // 2 AS place, place AS below, node, held FROM outer_nodes WHERE held > 1)
  GROUP BY level, place),
siblings AS (
  SELECT d.doc_id, n.level, n.node, n.place % 2 = 0 AS before
  FROM leaves d JOIN inner_nodes n ON n.lang IS NOT DISTINCT FROM d.lang AND n.place = xor(d.place >> n.level, 1) AND n.held > 1
  UNION ALL
  SELECT d.doc_id, s.height + n.level, n.node, n.place % 2 = 0
  FROM leaves d JOIN subroots s ON s.lang IS NOT DISTINCT FROM d.lang
  JOIN outer_nodes n ON n.place = xor(s.place >> n.level, 1) AND n.held > 1),
heights AS (
  SELECT doc_id, subroot, height + (SELECT max(level) FROM outer_nodes) AS height
  FROM leaves d JOIN subroots s ON s.lang IS NOT DISTINCT FROM d.lang),
folded(doc_id, level, node) AS (
  SELECT doc_id, 0, shown FROM leaves
  UNION ALL
  SELECT f.doc_id, f.level + 1, sha256(CASE WHEN s.node IS NULL THEN f.node WHEN before THEN s.node || f.node
    ELSE f.node || s.node END)
  FROM folded f JOIN heights h ON h.doc_id = f.doc_id AND f.level < h.height
  LEFT JOIN siblings s ON s.doc_id = f.doc_id AND s.level = f.level),
proofs AS (SELECT doc_id, string_agg(node, '' ORDER BY level) AS proof FROM siblings GROUP BY doc_id),
root AS (SELECT node AS root FROM outer_nodes WHERE held = 1)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, f.node AS folded_root, f.node = root AS verified
FROM leaves JOIN heights h USING (doc_id) JOIN folded f ON f.doc_id = leaves.doc_id AND f.level = h.height
LEFT JOIN proofs USING (doc_id) CROSS JOIN root
"""


@query("op11_merkle_manifest", MANIFEST_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    columns = {name: F.col(name) for name in docs.columns}
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    tampered = merkle.leaf_digest(*(columns | {"n_chars": more}).values())
    found = merkle.manifest(
        docs, merkle.leaf_digest(*columns.values()), F.when(id_remainder(F.col("doc_id"), 7) == 0, tampered)
    )
    return found.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


RUNS_SQL = rf"""
WITH {CRC32_SQL.strip()},
split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, crc AS h FROM documents JOIN crc USING (doc_id)),
sized AS (SELECT *, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a, 3 + (h // 10) % 8 AS parts FROM split),
texts AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0
    THEN list_concat(w[1 : a], [w[a + 1 + i % (1 + (n - a) // parts)] FOR i IN range(n - a)]) ELSE w END AS w
  FROM sized),
words AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM texts),
same AS (
  SELECT doc_id, x.i, y.i - x.i AS period
  FROM words x JOIN words y USING (doc_id, word) WHERE y.i > x.i AND 3 * (y.i - x.i) <= x.n),
islands AS (
  SELECT doc_id, period, min(i) AS start, count(*) + period AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, period ORDER BY i) AS island FROM same)
  GROUP BY doc_id, period, island),
runs AS (
  SELECT doc_id, start, CAST(length AS BIGINT) AS length, min(period) AS period FROM islands
  WHERE length >= greatest(24, 3 * period) GROUP BY doc_id, start, length),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t
  FROM runs GROUP BY doc_id),
best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(listed.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def repeated_tail(doc_id: Column, text: Column) -> Column:
    """The text of op13: in every tenth document by its id, the words from some word on repeat a part of themselves."""
    checksum = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")))
    number = F.floor(checksum / 10)
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size(words)
    start = (number % F.greatest(n, F.lit(1))).cast("int")
    period = (1 + F.floor((n - start) / (3 + number % 8))).cast("int")
    copies = F.ceil((n - start) / period).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, start + 1, period), copies)), F.lit(1), n - start)
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), start), tail), " ")
    return F.when(checksum % 10 == 0, changed).otherwise(text)


@query("op13_periodic_runs", RUNS_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", repeated_tail(F.col("doc_id"), F.col("text")).alias("text"))
    best = periodic.strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = periodic.find_runs(docs, least=24).withColumn("best", best)
    return found.select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


BYTES_SQL = """
WITH texts AS (SELECT doc_id, encode(coalesce(text, '')) AS b, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
starts AS (SELECT doc_id, b, unnest(range(1, n - 198)) AS s FROM texts),
windows AS (SELECT doc_id, s, b[s : s + 199] AS w FROM starts),
repeated AS (SELECT doc_id, s FROM windows QUALIFY count(*) OVER (PARTITION BY md5(w)) > 1),
stretches AS (
  SELECT doc_id, min(s) AS a, max(s) + 200 AS z
  FROM (SELECT *, s - row_number() OVER (PARTITION BY doc_id ORDER BY s) AS island FROM repeated) GROUP BY doc_id, island),
marked AS (
  SELECT *, coalesce(a > max(z) OVER (PARTITION BY doc_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS fresh
  FROM stretches),
spans AS (
  SELECT doc_id, min(a) AS a, max(z) AS z
  FROM (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY a) AS span FROM marked) GROUP BY doc_id, span),
gaps AS (
  SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 1) AS begin, a AS until FROM spans
  UNION ALL SELECT doc_id, NULL, NULL, max(z), NULL FROM spans GROUP BY doc_id),
cut AS (
  SELECT g.doc_id, CAST(count(a) AS BIGINT) AS n_spans, CAST(coalesce(sum(z - a), 0) AS BIGINT) AS n_removed,
    string_agg(hex(b[begin : coalesce(until, n + 1) - 1]), '' ORDER BY begin) FILTER (begin < coalesce(until, n + 1)) AS kept
  FROM gaps g JOIN texts USING (doc_id) GROUP BY g.doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(CASE WHEN n_spans IS NULL THEN b ELSE unhex(coalesce(kept, '')) END) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
"""


@query("op12_suffix_dedup", BYTES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_dedup.remove_repeated(docs, window=200)
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
