"""Removal of repeated passages, found with difference-cover anchors.

A word is removed if a window of ``window`` words that covers it has the same words as a window that starts earlier (in a
document with a smaller id, or earlier in the same one). Positions of a document whose remainder modulo 13 is in the
cover {0, 1, 3, 9} are anchors, and the 8 words from each anchor on are hashed. Whatever the offset between two equal
windows of 20 words, some two of their anchors lie at the same distance from the windows' starts, so both windows hold
an anchor whose hash occurs twice. Only windows around such anchors are extended to their full length and compared.

Documents are dealt to buckets of about ``BUCKET_BYTES`` of text; a bucket sends each distinct hash once, so the most
frequent passage gives one entry per bucket:

1. buckets send the distinct hashes of their anchors, by hash, and learn which occur more than once;
2. they send a hash of 96 bits and the first place of each distinct candidate window, by hash, and learn which of these have an
   earlier equal elsewhere;
3. with that, and the repetitions inside the bucket, words are marked and removed.

Defined results: a null text has no words. Words are separated by ASCII white space and compared unchanged. Documents of
fewer words than a window lose nothing. Rows with one id count as equally early: only a smaller start in the other row is
earlier. A null id counts as the largest. ``kept`` is the remaining words joined by blanks. Extra columns pass through in
the struct ``row``. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trailperks.llm.common import binary_list, shuffle_partitions, small_batches, text_bytes, with_row
from trailperks.llm.words import Words, column_of, flat, in_buckets, lists, words_of

PERIOD, COVER = 13, (0, 1, 3, 9)
BUCKET_BYTES, PART_BYTES = 4 * 1024**2, 32 * 1024**2
LAST_ID = 2**63 - 1


def anchored_words(window: int) -> int:
    """Words hashed at an anchor: a window of any phase holds that many from an aligned anchor on."""
    if window <= PERIOD:
        raise ValueError(f"windows must be longer than {PERIOD} words")
    return window - PERIOD + 1


class Bucket:
    """The documents of a bucket in the order of their ids."""

    def __init__(self, table: pa.Table, window: int, text: str):
        texts = binary_list(column_of(table, text))
        ids = table["id"].combine_chunks().fill_null(LAST_ID).to_numpy(zero_copy_only=False)
        self.order = sorted(range(len(texts)), key=lambda row: (ids[row], texts[row]))
        self.texts = [texts[row] for row in self.order]
        self.ids = ids[self.order]
        self.words: Words = words_of(self.texts)
        self.window = window
        self.places = self.words.places
        self.left = np.repeat(self.words.counts.astype(np.int32), self.words.counts) - self.places

    def anchors(self) -> np.ndarray:
        """Positions of anchors in documents that hold a window."""
        long_enough = np.repeat(self.words.counts >= self.window, self.words.counts)
        fits = self.left >= anchored_words(self.window)
        return np.flatnonzero(long_enough & fits & np.isin(self.places % PERIOD, COVER))

    def windows(self, anchors: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold one of the anchors."""
        total = np.zeros(len(self.places) + PERIOD + 1, np.int64)
        total[anchors + 1] = 1
        total = np.cumsum(total)
        at = np.arange(len(self.places))
        return np.flatnonzero((total[at + PERIOD] - total[at] > 0) & (self.left >= self.window))

    def groups(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the windows (two lanes), and for each window the earliest equal one, as an index into ``starts``."""
        one = self.words.runs(self.window)[starts]
        two = (self.words.runs(self.window, 1)[starts] >> np.uint64(32)).astype(np.int64)
        order = np.lexsort((starts, two, one))
        new = np.ones(len(order), bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        # Rows with one id stand next to each other but count as equally early.
        documents = self.words.documents[starts]
        numbers = np.cumsum(new) - 1
        smallest = np.lexsort((self.places[starts][order], self.ids[documents][order], numbers))
        heads = smallest[np.searchsorted(numbers[smallest], np.arange(new.sum()))]
        first = np.empty(len(order), np.int64)
        first[order] = order[heads][numbers]
        return one, two, first


def send(bucket: int, parts: np.ndarray, number: int, columns: dict[str, tuple[np.ndarray, pa.DataType]]) -> pa.Table:
    """A row per part with the values that go there."""
    order = np.argsort(parts, kind="stable")
    sizes = np.bincount(parts, minlength=number)
    used = np.flatnonzero(sizes)
    out = {"part": pa.array(used, pa.int32()), "bucket": pa.array(np.full(len(used), bucket), pa.int32())}
    return pa.table(out | {name: lists(values[order], sizes[used], kind) for name, (values, kind) in columns.items()})


def reply(buckets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Table:
    """A row per bucket with the values that go back to it."""
    order = np.argsort(buckets, kind="stable")
    used, sizes = np.unique(buckets, return_counts=True)
    return pa.table({"bucket": pa.array(used, pa.int32()), "found": lists(values[order], sizes, kind)})


def remove_repeated(docs: DataFrame, window: int = 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, n_words, n_removed, kept): a row per document."""
    spark = docs.sparkSession
    small_batches(spark)
    size = text_bytes(docs, text)
    partitions = shuffle_partitions(spark)
    buckets, parts = max(partitions, -(-size // BUCKET_BYTES)), max(partitions, -(-size // PART_BYTES))
    length = anchored_words(window)

    def send_anchors(table: pa.Table) -> pa.Table:
        bucket = Bucket(table, window, text)
        hashes, counts = np.unique(bucket.words.runs(length)[bucket.anchors()], return_counts=True)
        return send(
            table["bucket"][0].as_py(),
            (hashes % np.uint64(parts)).astype(np.int64),
            parts,
            {"hash": (hashes.view(np.int64), pa.int64()), "again": (counts > 1, pa.bool_())},
        )

    def repeated(table: pa.Table) -> pa.Table:
        hashes, sizes = flat(table["hash"])
        again, _ = flat(table["again"])
        owners = np.repeat(table["bucket"].to_numpy(), sizes)
        distinct, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        often = counts > 1
        often[inverse[again.astype(bool)]] = True
        return reply(owners[often[inverse]], hashes[often[inverse]], pa.int64())

    def send_windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        bucket = Bucket(table, window, text)
        anchors = bucket.anchors()
        known = flat(answers["found"])[0].view(np.uint64) if answers.num_rows else np.empty(0, np.uint64)
        starts = bucket.windows(anchors[np.isin(bucket.words.runs(length)[anchors], known)])
        one, two, first = bucket.groups(starts)
        heads = np.unique(first)
        return send(
            table["bucket"][0].as_py() if table.num_rows else 0,
            (one[heads] % np.uint64(parts)).astype(np.int64),
            parts,
            {
                "one": (one[heads].view(np.int64), pa.int64()),
                "two": (two[heads].astype(np.int32, casting="unsafe"), pa.int32()),
                "id": (bucket.ids[bucket.words.documents[starts[heads]]], pa.int64()),
                "start": (bucket.places[starts[heads]], pa.int32()),
                "place": (starts[heads], pa.int32()),
            },
        )

    def later(table: pa.Table) -> pa.Table:
        one, sizes = flat(table["one"])
        two, ids, starts, places = (flat(table[name])[0] for name in ("two", "id", "start", "place"))
        order = np.lexsort((starts, ids, two, one))
        one, two, ids, starts = one[order], two[order], ids[order], starts[order]
        new = np.ones(len(order), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        # Rows under one id may lie in several buckets; only a smaller start is earlier among them.
        after = (ids > ids[first]) | (starts > starts[first])
        owners = np.repeat(table["bucket"].to_numpy(), sizes)[order]
        return reply(owners[after], places[order][after], pa.int32())

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        bucket = Bucket(table, window, text)
        starts = np.flatnonzero(bucket.left >= window)
        _, _, first = bucket.groups(starts)
        elsewhere = np.zeros(len(bucket.places) + 1, bool)
        if answers.num_rows:
            elsewhere[flat(answers["found"])[0]] = True
        ids, places = bucket.ids[bucket.words.documents[starts]], bucket.places[starts]
        after = (ids > ids[first]) | (places > places[first])
        repeated_at = starts[after | elsewhere[starts[first]]]
        covered = np.zeros(len(bucket.places) + window + 1, np.int64)
        np.add.at(covered, repeated_at, 1)
        np.add.at(covered, repeated_at + window, -1)
        gone = np.cumsum(covered)[: len(bucket.places)] > 0
        kept, removed = [], []
        for text_, begin, count in zip(bucket.texts, bucket.words.firsts.tolist(), bucket.words.counts.tolist()):
            mask = gone[begin : begin + count]
            removed.append(int(mask.sum()))
            words = text_.split()
            kept.append(b" ".join(compress(words, ~mask) if removed[-1] else words))
        return pa.table(
            {
                "row": table["row"].combine_chunks().take(pa.array(bucket.order, pa.int64())),
                "n_words": pa.array(bucket.words.counts),
                "n_removed": pa.array(removed, pa.int64()),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )

    dealt = in_buckets(docs, buckets, doc_id, text)
    texts = dealt.groupBy("bucket")
    anchors = texts.applyInArrow(send_anchors, "part int, bucket int, hash array<bigint>, again array<boolean>")
    often = anchors.groupBy("part").applyInArrow(repeated, "bucket int, found array<bigint>")
    windows = texts.cogroup(often.groupBy("bucket")).applyInArrow(
        send_windows, "part int, bucket int, one array<bigint>, two array<int>, id array<bigint>, start array<int>, place array<int>"
    )
    earlier = windows.groupBy("part").applyInArrow(later, "bucket int, found array<int>")
    return texts.cogroup(earlier.groupBy("bucket")).applyInArrow(
        remove, with_row(dealt, "n_words long, n_removed long, kept string")
    )
