"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept; what it returns is written as Parquet in
the shared folder and read again as the next one's ``docs``. All but the last return the columns of ``documents``:

* ``language_id`` drops documents without a letter and those whose language is uncertain (``LEAST_SCORE``);
* ``near_dedup`` keeps the document with the smallest id of each SimHash component;
* ``substring_dedup`` removes words of passages that occur earlier; documents without any keep their text as it is;
* ``pii`` replaces personal data by the names of its kinds and hides the terms that disclose it;
* ``packing`` returns the pieces of token sequences, with their ids.

``n_chars`` is counted anew where a stage changes texts. Empty input passes through as empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from trailperks.llm import language, packing, pii, simhash, substrings
from trailperks.llm.common import id_remainder, keep, table

#: The least calibrated probability with which a document's language must be known. Short clean texts are often told right with
#: less than one half; below this a text is told apart hardly better than by chance.
LEAST_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.fit(docs, id_remainder(F.col("doc_id"), 3) != 1)
    judged = language.identify(docs, model)
    return judged.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, shingle=3, max_bits=2)


def with_text(docs: DataFrame, changed: DataFrame, text) -> DataFrame:
    """The columns of ``docs`` from the struct ``row`` of ``changed``, with another text."""
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return changed.select([new[name].alias(name) if name in new else F.col(f"row.`{name}`") for name in docs.columns])


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeated(docs, window=20)
    return with_text(docs, found, F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text")))


def protect(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_text(docs, pii.protect(docs), F.col("sanitised"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, capacity=2048)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("pii", protect),
    ("packing", pack),
]

#: SQL expresses neither the classifier nor the tokenizer; tests/llm/test_corpus_pipeline.py compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
