"""Personal data: fixed patterns, and terms that give the found entities away.

Base spans are e-mail addresses, IP addresses, payment cards (Luhn) and phone numbers. The values found are the
protected entities. A term is a run of letters and digits outside the base spans. Over the distinct texts of the corpus are
counted: the texts N, those with entity e, those with term t, and those with both, wherever they stand. What t tells about
e is their pointwise mutual information, log(N n(t,e) / (n(t) n(e))); as a share of all there is to learn, log(N / n(e)),
it is the disclosure of e by t. From ``GENERALISE`` on, a term is replaced by a class name; from ``REMOVE`` on, it is
removed. This holds for every place where the term stands, in every document, with the entity or without.

A pair counts if it is no coincidence: were t and e independent, n(t,e) texts or more of the n(t) would have e with a
probability of at most exp(-n(t) KL(n(t,e) / n(t), n(e) / N)) (Chernoff); this may not exceed ``CHANCE``, divided by the
number of terms tried with e, the distinct terms V of the corpus. There is no least number of texts, but an entity of two
texts reaches the bound from about N = 2 sqrt(V / CHANCE) on, one of a single text only from N = V / CHANCE on: in smaller
corpora any rare word of its text would do. Copies of one text count once and are no evidence.

Counting is by partial aggregation, so a frequent entity or term costs one row per task. Terms too frequent to disclose any
entity (n(t,e) is at most n(e), which bounds n(t)), and terms and entities too rare to reach the bound, are left out before
terms meet entities, an exact reduction. Terms to
hide are joined, as a stored table of known size, with the distinct terms of each document, of which those are left out
whose hash no hidden term has (a bitmap of ``BITS``, 1 MB); what is found goes back to the documents.

Defined results: a null text is empty; it has no spans and stays null. Matches of a kind are leftmost and do not overlap;
matches that fail a check are dropped without a second try. Term spans do not overlap base spans. Repeated rows and null
ids are documents like any other. Extra columns pass through in the struct ``row``. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F

from trailperks.llm.common import LOWER, UPPER, field_of, keep, slices, small_batches, with_row

KINDS = ["email", "ip", "card", "phone", "term"]
GENERALISE, REMOVE = 0.6, 0.9
#: The probability with which any of the terms tried with an entity may be taken by coincidence.
CHANCE = 0.01
BITS = 2**23
SLICE_BYTES = 2 * 1024**2
#: Terms to hide are held by every task up to so many bytes; more are joined.
HELD_BYTES = 4 * 1024**2

# Possessive and anchored forms of the contract's patterns: the same matches, in linear time.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: The same terms in a text of ASCII characters only, in lower case, and in any text.
ASCII_TERM, TERM = re.compile("[a-z0-9]+"), regex.compile(r"[\p{L}\p{N}]+")
NOT_DIGITS = re.compile(r"[^0-9]+")
TO_LOWER = str.maketrans(UPPER, LOWER)


def emails(text: str) -> Iterator[tuple[int, int]]:
    at = end = 0
    while (at := text.find("@", at)) >= 0:
        begin = at
        while begin > end and text[begin - 1] in LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at) if begin < at else None
        if domain:
            end = domain.end()
            yield begin, end
        at = max(at + 1, end)


def passes_luhn(digits: str) -> bool:
    total = 0
    for n, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + n % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    for match in ADDRESS.finditer(text):
        parts = [part.lstrip("0") for part in match.group().split(".")]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            out.append(("ip", *match.span()))
    for match in CARD.finditer(text):
        if match.end() - match.start() >= 14:
            digits = NOT_DIGITS.sub("", match.group())
            if 14 <= len(digits) <= 19 and passes_luhn(digits):
                out.append(("card", *match.span()))
    if "+" in text:
        for match in PHONE.finditer(text):
            if 10 <= len(NOT_DIGITS.sub("", match.group())) <= 15:
                out.append(("phone", *match.span()))
    return sorted(out, key=lambda span: (span[1], KINDS.index(span[0])))


def entity_of(kind: str, value: str) -> str:
    """One name for the ways to write a value."""
    return f"{kind}:{NOT_DIGITS.sub('', value) if kind in ('card', 'phone') else value.translate(TO_LOWER)}"


def free_terms(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) of all terms without those that are part of a base span."""
    taken = at = 0
    lowered = text.translate(TO_LOWER)
    for match in (ASCII_TERM if lowered.isascii() else TERM).finditer(lowered):
        a, b = match.span()
        while at < len(spans) and spans[at][1] < b:
            taken = max(taken, spans[at][2])
            at += 1
        if taken <= a:
            yield match.group(), a, b


def in_term(letter: str) -> bool:
    return letter.isalnum() if letter.isascii() else TERM.match(letter) is not None


def places_of(terms: Iterable[str], text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) of the given terms among :func:`free_terms`, without looking at the others."""
    lowered = text.translate(TO_LOWER)
    for term in terms:
        at = lowered.find(term)
        while at >= 0:
            end = at + len(term)
            alone = not (at and in_term(lowered[at - 1])) and not (end < len(lowered) and in_term(lowered[end]))
            if alone and all(stop <= at or start >= end for _, start, stop in spans):
                yield term, at, end
            at = lowered.find(term, end if alone else at + 1)


def distinct_terms(text: str, spans: list[tuple[str, int, int]]) -> list[str]:
    if spans:
        return list({term for term, _, _ in free_terms(text, spans)})
    lowered = text.translate(TO_LOWER)
    return list(set((ASCII_TERM if lowered.isascii() else TERM).findall(lowered)))


def sliced(batches: Iterator[pa.RecordBatch], column) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``SLICE_BYTES`` of text, so that few texts are Python objects at a time."""
    for batch in batches:
        for begin, end in slices(column(batch), SLICE_BYTES):
            yield batch.slice(begin, end - begin)


def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct entities and terms of each document."""
    for batch in sliced(batches, lambda whole: whole.column(3)):
        entities, terms = [], []
        for text in batch.column(3).to_pylist():
            spans = base_spans(text or "")
            entities.append(list({entity_of(kind, text[start:end]) for kind, start, end in spans}))
            terms.append(distinct_terms(text or "", spans))
        kind = pa.list_(pa.string())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(entities, kind), pa.array(terms, kind)], names=["row_id", "doc", "mark", "entities", "terms"]
        )


def sanitise(text: str, spans: list[tuple[str, int, int]], removed: set[tuple[int, int]]) -> str:
    """Each span replaced by the name of its class, or nothing; of overlapping spans the first names the class."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], "" if (start, end) in removed else f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def disclosing_terms(found: DataFrame) -> DataFrame:
    """(term, remove): terms whose disclosure of an entity reaches the threshold and is no coincidence."""
    rows = found.select("mark", "row_id")
    firsts = rows.groupBy("mark").agg(F.min("row_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = keep(rows.join(firsts, "mark").where("row_id != first").select("row_id"), "pii-copies")
    texts = found.join(copies, "row_id", "left_anti")
    total = float(texts.count())
    documents = keep(
        texts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("of_term")), "pii-counts", compression="zstd"
    )
    bound = math.log(max(1, documents.count()) / CHANCE)
    # No pair is as little a coincidence as one in which all texts of the rarer one have the other.
    least = bound / (math.log(max(2.0, total)) * (1 + 1e-9))
    with_entity = texts.where(F.size("entities") > 0)
    entities = keep(
        with_entity.select(F.explode("entities").alias("entity"))
        .groupBy("entity")
        .agg(F.count("*").alias("of_entity"))
        # An entity of all texts has nothing left to learn.
        .where((F.col("of_entity") < total) & (F.col("of_entity") >= least)),
        "pii-entities",
    )
    # The most texts a term can have whose disclosure of e reaches the threshold: n(e) (N / n(e)) ** (1 - GENERALISE).
    most = F.col("of_entity") * F.pow(F.lit(total) / F.col("of_entity"), F.lit(1 - GENERALISE)) * (1 + 1e-9)
    limit = entities.agg(F.max(most)).first()[0] or 0.0
    protected = (
        with_entity.select("row_id", F.explode("entities").alias("entity")).join(entities, "entity").withColumn("most", most)
    )
    candidates = (
        with_entity.select("row_id", F.explode("terms").alias("term"))
        .join(documents.where((F.col("of_term") <= limit) & (F.col("of_term") >= least)), "term")
        .select("row_id", "term", "of_term")
    )
    rarer, other = F.least("of_term", "of_entity"), F.greatest("of_term", "of_entity")
    pairs = (
        candidates.join(protected, "row_id")
        .where((F.col("of_term") <= F.col("most")) & (rarer * F.log(F.lit(total) / other) * (1 + 1e-9) >= bound))
        .groupBy("entity", "term")
        .agg(F.count("*").alias("together"), *[F.first(name).alias(name) for name in ("of_term", "of_entity")])
    )
    together, of_term, share = F.col("together"), F.col("of_term"), F.col("of_entity") / F.lit(total)
    told, whole = F.log(together / (of_term * share)), -F.log(share)
    without = F.when(of_term > together, (of_term - together) * F.log((1 - together / of_term) / (1 - share))).otherwise(0.0)
    disclosure = told / whole
    return (
        pairs.where((disclosure >= GENERALISE) & (together * told + without >= bound))
        .groupBy("term")
        .agg(F.max(disclosure >= REMOVE).alias("remove"))
    )


def marked_bits(hidden: DataFrame) -> np.ndarray:
    """A bit for each of ``BITS`` remainders of a term's hash, set where there is a hidden term: of one size always."""
    bit = F.xxhash64("term").bitwiseAND(F.lit(BITS - 1))
    blocks = hidden.groupBy(F.shiftright(bit, 15).alias("block")).agg(F.bitmap_construct_agg(bit.bitwiseAND(F.lit(2**15 - 1))).alias("bits"))
    out = np.zeros((BITS // 2**15, 2**12), np.uint8)
    for row in blocks.collect():
        out[row.block] = np.frombuffer(row.bits, np.uint8)
    return out.ravel()


def possible(bits: np.ndarray):
    """For mapInArrow: a row per document and term, without terms whose bit says that they are not hidden."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = batch.column(2)
            coded = terms.flatten().dictionary_encode()
            hashes = [xxhash.xxh64_intdigest(term, 42) & (BITS - 1) for term in coded.dictionary.to_pylist()]
            at = np.array(hashes, np.int64)  # as Spark's xxhash64
            marked = (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            places = np.flatnonzero(marked[coded.indices.to_numpy()])
            rows = np.repeat(np.arange(batch.num_rows), terms.value_lengths().to_numpy())[places]
            columns = [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)), terms.flatten().take(pa.array(places))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "mark", "term"])

    return run


def hide(text: str | None, hidden: dict[str, bool]) -> tuple[list[dict], str | None]:
    """The spans of a text, and the text without what they hold, given the terms to hide (true: to remove)."""
    spans = base_spans(text or "")
    places: dict[tuple[int, int], bool] = {}
    if hidden:
        places = {(a, b): hidden[term] for term, a, b in places_of(hidden, text, spans)}
        spans = sorted(spans + [("term", a, b) for a, b in places], key=lambda span: (span[1], KINDS.index(span[0])))
    removed = {place for place, remove in places.items() if remove}
    return [{"kind": k, "start": a, "end": b} for k, a, b in spans], sanitise(text, spans, removed) if spans else text


def rewritten(rows: pa.Array, results: list[tuple[list[dict], str | None]]) -> pa.RecordBatch:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [rows, pa.array([spans for spans, _ in results], kind), pa.array([text for _, text in results], pa.string())],
        names=["row", "spans", "sanitised"],
    )


HIDDEN = "spans array<struct<kind: string, start: bigint, end: bigint>>, sanitised string"


def protect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, spans, sanitised): spans are (kind, start, end) in code points, by start, then kind."""
    small_batches(docs.sparkSession)
    mark = F.xxhash64(F.lit(5), F.col(text))
    keyed = docs.select(
        F.struct("*").alias("row"), F.col(doc_id).cast("long").alias("doc"), mark.alias("mark"), F.col(text).alias("text")
    )
    found = keep(
        keyed.select(F.monotonically_increasing_id().alias("row_id"), "doc", "mark", "text").mapInArrow(
            described, "row_id long, doc long, mark long, entities array<string>, terms array<string>"
        ),
        "pii-documents",
        compression="zstd",
    )
    hidden = keep(disclosing_terms(found), "pii-terms")
    size = hidden.agg(F.sum(F.octet_length("term") + F.lit(1).cast("long"))).first()[0] or 0
    if size <= HELD_BYTES:
        return hide_held(docs, {row.term: row.remove for row in hidden.collect()}, text)
    return hide_joined(keyed, found, hidden, text)


def hide_held(docs: DataFrame, held: dict[str, bool], text: str) -> DataFrame:
    """With few terms to hide, every task holds them all and no text moves."""
    rows = docs.select(F.struct("*").alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, lambda whole: field_of(whole.column(0), text)):
            results = []
            for own in field_of(batch.column(0), text).to_pylist():
                own_terms = held.keys() & distinct_terms(own or "", []) if held else ()
                results.append(hide(own, {term: held[term] for term in own_terms}))
            yield rewritten(batch.column(0), results)

    return rows.mapInArrow(run, with_row(rows, HIDDEN))


def hide_joined(keyed: DataFrame, found: DataFrame, hidden: DataFrame, text: str) -> DataFrame:
    """With many, each text meets its own: terms are dropped by a bit map of a fixed size, the others joined."""
    hits = keep(
        found.select("doc", "mark", "terms")
        .mapInArrow(possible(marked_bits(hidden)), "doc long, mark long, term string")
        .join(hidden, "term")
        .groupBy(F.col("doc").alias("hit_doc"), F.col("mark").alias("hit_mark"))
        .agg(F.collect_set(F.struct("term", "remove")).alias("hits")),
        "pii-hits",
    )
    joined = keyed.join(
        hits, keyed["doc"].eqNullSafe(hits["hit_doc"]) & (keyed["mark"] == hits["hit_mark"]), "left"
    ).select("row", "hits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, lambda whole: field_of(whole.column(0), text)):
            texts = zip(field_of(batch.column(0), text).to_pylist(), batch.column(1).to_pylist())
            results = [hide(own, {hit["term"]: hit["remove"] for hit in hits or ()}) for own, hits in texts]
            yield rewritten(batch.column(0), results)

    return joined.mapInArrow(run, with_row(joined, HIDDEN))


def disclosure(total: int, of_entity: int, of_term: int, together: int) -> float:
    """The measure for single numbers, as :func:`disclosing_terms` computes it."""
    whole = math.log(total / of_entity)
    return math.log(together * total / (of_term * of_entity)) / whole if whole > 0 else 0.0
