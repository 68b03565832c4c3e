"""Packing token sequences: first-fit decreasing with a tournament tree of bin capacities.

Documents are dealt at random (by a hash of id, text and input partition) to groups of about ``GROUP_BYTES`` of text; a group is a shuffle
partition and is packed on its own, so no task ever sees more than its group and the longest document. Each
document becomes the ids of its text and an end id. Whole lengths of a sequence are cut off first; what is left of
each document is placed, longest first, into the first bin with room, which the tree of largest free capacities finds in
logarithmic time. Bins that are still not full are then filled with pieces cut from the emptiest ones, so one bin per
group remains, and its content is cut into sequences whose lengths are powers of two, which need no padding.

Defined results: a null text is empty and has only the end id; a null or repeated id is kept as it is, each row being a
document of its own; an empty table gives no pieces. Equal texts need no care, as only lengths matter to packing. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from trailperks.llm.common import shuffle_partitions, slices, small_batches, text_bytes
from trailperks.llm.encoding import WordEncoder

GROUP_BYTES = 8 * 1024**2
SLICE_BYTES = 2 * 1024**2
WORDS_PER_CALL = 10_000


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> WordEncoder:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]

    def encode_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, lengths = [], []
        for at in range(0, len(texts), WORDS_PER_CALL):
            # One call takes many words, as texts of their own.
            part = texts[at : at + WORDS_PER_CALL]
            encoded = tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            lengths.append(np.bincount(np.array(encoded.word_ids, dtype=np.int64), minlength=len(part)))
            ids.append(np.array(encoded.ids, dtype="<u4"))
        return np.concatenate(ids), np.concatenate(lengths)

    return WordEncoder(encode_words, [end_id], added)


class TournamentTree:
    """Free capacities of bins; the winner of each match is the larger one."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1
        while self.leaves < max(1, bins):
            self.leaves *= 2
        self.free = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Put ``size`` into the first bin with room and return the bin."""
        at, free = 1, self.free
        while at < self.leaves:
            at *= 2
            if free[at] < size:
                at += 1
        found = at - self.leaves
        free[at] -= size
        at //= 2
        while at:
            free[at] = max(free[2 * at], free[2 * at + 1])
            at //= 2
        return found


def first_fit_decreasing(pieces: list[tuple[int, int, int]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Bins of (document, start, length); ``pieces`` come in decreasing length."""
    tree = TournamentTree(len(pieces), capacity)
    bins: list[list[tuple[int, int, int]]] = []
    for piece in pieces:
        found = tree.place(piece[2])
        if found == len(bins):
            bins.append([])
        bins[found].append(piece)
    return bins


def fill_up(bins: list[list[tuple[int, int, int]]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Cut the content of the emptiest bins into the gaps of the others; the last bin is cut at powers of two."""
    free = [capacity - sum(piece[2] for piece in content) for content in bins]
    order = sorted(range(len(bins)), key=lambda x: (free[x], x))
    bins, free = [bins[x] for x in order], [free[x] for x in order]
    to, giver = 0, len(bins) - 1
    while to < giver:
        if not free[to]:
            to += 1
            continue
        document, start, length = bins[giver].pop()
        cut = min(length, free[to])
        bins[to].append((document, start + length - cut, cut))
        free[to] -= cut
        if cut < length:
            bins[giver].append((document, start, length - cut))
        if not bins[giver]:
            bins.pop()
            giver -= 1
    if not bins:
        return bins
    last = bins.pop()
    left = sum(piece[2] for piece in last)
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        part: list[tuple[int, int, int]] = []
        while size:
            document, start, length = last.pop()
            cut = min(length, size)
            part.append((document, start + length - cut, cut))
            size -= cut
            if cut < length:
                last.append((document, start, length - cut))
        bins.append(part)
    return bins


def pack_group(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) for documents in a fixed order."""
    whole, rest = [], []
    for document, length in enumerate(lengths):
        full = length // capacity
        whole.extend([(document, n * capacity, capacity)] for n in range(full))
        if length % capacity:
            rest.append((document, full * capacity, length % capacity))
    rest.sort(key=lambda piece: (-piece[2], piece[0]))
    return whole + fill_up(first_fit_decreasing(rest, capacity), capacity)


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, seed: int = 7, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): a row per piece, ids as little-endian 32 bits."""
    spark = docs.sparkSession
    small_batches(spark)
    groups = max(shuffle_partitions(spark), -(-text_bytes(docs, text) // GROUP_BYTES))
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for batch in batches:
            for begin, stop in slices(batch.column(1), SLICE_BYTES):
                part = batch.slice(begin, stop - begin)
                ids = encoder(tokenizer, end_id).encode([x or "" for x in part.column(1).to_pylist()])
                found.extend(zip(part.column(0).to_pylist(), ids))
        # The order in which shuffled rows arrive may differ when a task runs again.
        found.sort(key=lambda x: (x[0] is None, x[0] if x[0] is not None else 0, x[1]))
        group = TaskContext.get().partitionId() << 32
        sequences = pack_group([len(x[1]) // 4 for x in found], capacity)
        rows = [
            (found[document][0], start, length, document, group + n, offset)
            for n, sequence in enumerate(sequences)
            for (document, start, length), offset in zip(sequence, np.cumsum([0] + [x[2] for x in sequence]).tolist())
        ]
        for at in range(0, len(rows), 2000):
            part = rows[at : at + 2000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in part], type=batch.schema.field(0).type),
                    pa.array([x[1] for x in part], pa.int64()),
                    pa.array([x[2] for x in part], pa.int64()),
                    pa.array([found[x[3]][1][4 * x[1] : 4 * (x[1] + x[2])] for x in part], pa.binary()),
                    pa.array([len(found[x[3]][1]) // 4 for x in part], pa.int64()),
                    pa.array([x[4] for x in part], pa.int64()),
                    pa.array([x[5] for x in part], pa.int64()),
                ],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    return (
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        .withColumn("from", F.spark_partition_id())  # so rows under one id spread
        .repartition(groups, F.xxhash64(F.lit(seed), "doc_id", "text", "from"))
        .drop("from")
        .mapInArrow(
            run,
            f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
        )
    )
