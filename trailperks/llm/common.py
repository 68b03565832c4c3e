"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from trailperks.session import new_run_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and leave every other letter as it is."""
    return F.translate(text, UPPER, LOWER)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def keep(frame: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Compute once: write to the shared folder and read back, so Spark knows the size and no executor holds the only copy."""
    folder = new_run_folder(frame.sparkSession, purpose)
    frame.write.options(**options).parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def discard(frame: DataFrame) -> None:
    """Delete what :func:`keep` wrote for this frame, which can't be read any more."""
    for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
        path = frame.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Other settings of the session while something is computed."""
    before = {key: spark.conf.get(key) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def with_row(frame: DataFrame, rest: str) -> T.StructType:
    """The schema of a result that carries the struct ``row`` of ``frame`` and the columns in ``rest``."""
    return T.StructType([frame.schema["row"], *T.StructType.fromDDL(rest).fields])


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts, the measure from which numbers of groups are derived."""
    return docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Send documents to Python in batches of at most this many, as both sides hold a batch several times over."""
    if not 0 < int(spark.conf.get(BATCH_ROWS)) <= rows:
        spark.conf.set(BATCH_ROWS, str(rows))


def slices(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows of a text column with about ``limit`` bytes each, one row at least."""
    begin = total = 0
    for row, size in enumerate(pc.binary_length(column).fill_null(0).to_pylist()):
        if total and total + size > limit:
            yield begin, row
            begin, total = row, 0
        total += size + 1
    if begin < len(column):
        yield begin, len(column)


def field_of(rows: pa.StructArray, name: str) -> pa.Array:
    """A column of the documents in a struct column."""
    return pc.struct_field(rows, [rows.type.get_field_index(name)])


def binary_list(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of each text; a null text is empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]
