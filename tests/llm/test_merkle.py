from __future__ import annotations

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from trailperks.llm import merkle
from trailperks.llm.queries import op11

SMALL = "/root/testdata/sf0.001"


def sha(text):
    return sha256(text.encode()).hexdigest()


def plain_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][at : at + 2])) for at in range(0, len(levels[-1]), 2)])
    return levels


def plain_proof(levels, at):
    steps = []
    for level in levels[:-1]:
        beside = at ^ 1
        steps.append("" if beside >= len(level) else (">" if beside > at else "<") + level[beside])
        at //= 2
    return steps


def plain(rows):
    """(doc_id, lang, leaf, presented leaf) rows: what the manifest returns for each, as a sorted list."""
    groups = {}
    for doc_id, lang, leaf, shown in rows:
        groups.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, shown))
    names = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {lang: plain_tree([row[2] for row in sorted(groups[lang])]) for lang in names}
    outer = plain_tree([trees[lang][-1][0] for lang in names])
    out = []
    for number, lang in enumerate(names):
        for at, (known, doc_id, leaf, shown) in enumerate(sorted(groups[lang])):
            steps = plain_proof(trees[lang], at) + plain_proof(outer, number)
            node = shown
            for step in steps:
                node = sha(step[1:] + node if step[:1] == "<" else node + step[1:])
            out.append((doc_id if known else None, lang, leaf, trees[lang][-1][0], outer[-1][0], steps, node))
    return sorted(out, key=repr)


def found(docs, leaf, presented=None):
    rows = merkle.manifest(docs, leaf, presented).collect()
    return sorted(((r.key, r.tree, r.leaf, r.subroot, r.root, list(r.proof), r.folded_root) for r in rows), key=repr)


def compare(spark, rows):
    """Rows of (doc_id, lang); every third leaf that is put to the proof is another one."""
    docs = spark.createDataFrame([(i, lang, n) for n, (i, lang) in enumerate(rows)], "doc_id long, lang string, at long")
    leaf = F.sha2(F.concat(F.lit("leaf"), F.col("at").cast("string")), 256)
    other = F.when(F.col("at") % 3 == 0, F.sha2(F.lit("other"), 256))
    expected = plain(
        [(i, lang, sha(f"leaf{n}"), sha("other") if n % 3 == 0 else sha(f"leaf{n}")) for n, (i, lang) in enumerate(rows)]
    )
    assert found(docs, leaf, other) == expected


def test_trees_of_several_exchanges(spark):
    """A tree of three superblocks, one of exactly one, one more than that, and small ones; keys in no order."""
    size = 2**merkle.BLOCK_BITS
    sizes = {"en": 2 * size + 700, "fr": size, "de": size + 1, "": 5, "é": 1, "z": 2, None: 3}
    rows = [(n * 7919 % 1_000_003, lang) for lang, count in sizes.items() for n in range(count)]
    compare(spark, rows)


def test_as_many_groups_as_rows(spark):
    compare(spark, [(n, f"lang{n}") for n in range(1500)])


@pytest.mark.parametrize("count", [1, 2, 3, 7])
def test_one_group(spark, count):
    compare(spark, [(n, "en") for n in range(count)])


def test_one_key_and_no_key(spark):
    """A third of the rows under one id, a third without."""
    compare(spark, [([5, None, n][n % 3], ["en", None][n % 2]) for n in range(4000)])


def test_equal_rows(spark):
    docs = spark.createDataFrame([(1, "en")] * 3000 + [(2, "en")], "doc_id long, lang string")
    leaf = merkle.leaf_digest(F.col("doc_id"), F.col("lang"))
    one, two = plain_leaf([1, "en"]), plain_leaf([2, "en"])
    assert found(docs, leaf) == plain([(1, "en", one, one)] * 3000 + [(2, "en", two, two)])


def test_no_rows_and_other_columns(spark, documents):
    docs = documents([(1, "a", "fr")])
    for name in ("tree", "position", "total", "home", "lower", "node", "key", "at"):
        docs = docs.withColumn(name, F.lit(7))
    leaf = merkle.leaf_digest(F.col("doc_id"))
    assert found(docs.where("false"), leaf) == []
    assert found(docs, leaf) == [(1, "fr", sha("1:1"), sha("1:1"), sha("1:1"), [], sha("1:1"))]


def test_ids_keep_all_digits(spark):
    compare(spark, [(2**63 - 1, "en"), (2**63 - 2, "en"), (-(2**63), "en"), (None, "en")])


def test_leaf_digest(spark):
    rows = [(None, None), ("", 0), ("é\x00\n", -5), ("1:a", 2**63 - 1), ("long" * 100_000, 1)]
    docs = spark.createDataFrame(rows, "a string, b long")
    got = [r[0] for r in docs.select(merkle.leaf_digest(F.col("a"), F.col("b"))).collect()]
    assert got == [plain_leaf(row) for row in rows]


def test_query(spark):
    """Proofs of the given table fail where a row was changed, and only there."""
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = op11(spark, SMALL).collect()
    assert len(rows) == len(docs) and len({r.root for r in rows}) == 1
    for r in rows:
        d = docs[r.doc_id]
        assert r.leaf == plain_leaf([d.doc_id, d.source, d.lang, d.n_chars, d.text])
        assert r.verified == (r.folded_root == r.root)
    assert 0 < sum(not r.verified for r in rows) < len(rows) / 3
