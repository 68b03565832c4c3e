"""Words of many texts as arrays: hashes of words and of runs of words."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from trailperks.llm.common import field_of

SLICE = 2**20
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


@lru_cache(maxsize=1)
def byte_table() -> np.ndarray:
    """A random number for each byte value."""
    return np.array([xxhash.xxh64_intdigest(bytes([x]), 1) for x in range(256)], np.uint64)


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    if base not in _powers or len(_powers[base][0]) < count:
        size = max(2**16, 2 * count)
        both = []
        for factor in (base, pow(base, -1, 2**64)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        _powers[base] = tuple(both)
    return _powers[base][0][:count], _powers[base][1][:count]


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def hash_joined(joined: bytes) -> np.ndarray:
    """64-bit hashes of words that single blanks separate: one to one for words of up to seven bytes, XXH64 of longer ones."""
    out, at = [], 0
    while at < len(joined):
        end = joined.rfind(b" ", at, at + SLICE) if len(joined) - at > SLICE else len(joined)
        if end < 0:  # one word longer than a slice
            end = joined.find(b" ", at) % (len(joined) + 1)
        data = joined[at:end]
        buffer = data + b" " + bytes(8)
        ends = np.flatnonzero(np.frombuffer(buffer, np.uint8, len(data) + 1) == 32)
        begins = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1])
        lengths = (ends - begins).astype(np.uint64)
        # The eight bytes from each word on; what follows a short word gives way to its length.
        eight = np.ndarray((len(data) + 1,), "<u8", buffer, strides=(1,))[begins]
        short = np.minimum(lengths, np.uint64(7)) * np.uint64(8)
        hashes = mixed((eight & ((np.uint64(1) << short) - np.uint64(1))) | (lengths << np.uint64(56)))
        long = np.flatnonzero(lengths > 7)
        hashes[long] = [
            xxhash.xxh64_intdigest(data[a:b]) for a, b in zip(begins[long].tolist(), ends[long].tolist())
        ]
        out.append(hashes)
        at = end + 1
    return np.concatenate(out) if out else np.empty(0, np.uint64)


@dataclass
class Words:
    """Hashes of the words of several documents, one after the other."""

    hashes: np.ndarray
    counts: np.ndarray

    @property
    def firsts(self) -> np.ndarray:
        return np.cumsum(self.counts) - self.counts

    @property
    def documents(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.counts), dtype=np.int32), self.counts)

    @property
    def places(self) -> np.ndarray:
        """The position of each word in its document."""
        return np.arange(len(self.hashes), dtype=np.int32) - np.repeat(self.firsts.astype(np.int32), self.counts)

    def runs(self, length: int, lane: int = 0) -> np.ndarray:
        """Hash of the ``length`` words from each position on; meaningless where the document ends before."""
        up, down = powers(WORD_BASE, len(self.hashes) + 1)
        values = self.hashes if lane == 0 else mixed(self.hashes + np.uint64(lane))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[:-1])])
        ends = np.minimum(np.arange(len(values)) + length, len(values))
        return mixed((sums[ends] - sums[:-1]) * down[:-1])


def words_of(texts: list[bytes]) -> Words:
    """Words between ASCII white space, as ``bytes.split`` finds them."""
    counts, hashes, joined, size = [], [], [], 0
    for text in texts:
        words = text.split()
        counts.append(len(words))
        if words:
            joined.append(b" ".join(words))
            size += len(joined[-1])
        if size > SLICE:
            hashes.append(hash_joined(b" ".join(joined)))
            joined, size = [], 0
    hashes.append(hash_joined(b" ".join(joined)))
    return Words(np.concatenate(hashes), np.array(counts, np.int64))


def lists(values: np.ndarray, lengths, kind: pa.DataType) -> pa.Array:
    """A list column from the flat values of its rows."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows of a list column, and how many each row has."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], column.type)
    return array.flatten().to_numpy(zero_copy_only=False), np.diff(array.offsets.to_numpy())


def in_buckets(docs: DataFrame, buckets: int, doc_id: str, text: str = "text") -> DataFrame:
    """(bucket, id, row): documents dealt to groups of bounded size by their id, their text and the partition they come from.

    So rows under one id, or without, spread, even where they are equal. The text is shuffled once, inside the struct of all
    columns; :func:`column_of` takes it out.
    """
    spread = F.xxhash64(F.lit(3), F.col(doc_id), F.col(text), F.spark_partition_id())
    number = F.pmod(spread, F.lit(buckets)).cast("int")
    return docs.select(number.alias("bucket"), F.col(doc_id).cast("long").alias("id"), F.struct("*").alias("row"))


def column_of(table: pa.Table, name: str) -> pa.Array:
    """A column of the documents in a bucket."""
    return field_of(table["row"].combine_chunks(), name)
