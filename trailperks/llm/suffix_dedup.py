"""Removal of byte strings that occur more than once, found with suffix arrays.

A byte is removed if a string of ``window`` bytes that covers it also starts anywhere else, in the same text or another: no copy
stays. Texts are dealt to buckets of about ``BUCKET_BYTES``. A suffix array of everything would need everything in one
place, so windows are first dealt by their content, and each suffix array gets the strings that can hold equal windows:

1. The ``GRAM`` bytes with the smallest hash in a window are its anchor. Consecutive windows of one anchor form a string, the
   anchor's hash is its family. As the anchor depends on the window's bytes alone, equal windows have one family. Buckets send
   the hashes of their families and learn which occur again anywhere; windows of others are unique.
2. Buckets send the strings of these families, each distinct one once with its places. Strings of a family meet, and a suffix
   array (:mod:`trailperks.llm.suffix_arrays`) orders their suffixes. Windows that are neighbours there and equal in all bytes, and
   those of strings that occur twice, are repeated.
3. A family of more than ``FAMILY`` distinct strings (a passage beside which every document goes on differently) is dealt to several
   suffix arrays by the strings' hashes. What these leave open is settled by a 128-bit hash of each of their distinct windows.
4. Buckets get the places of repeated windows, and remove what these cover.

Defined results: a null text is empty. A text shorter than a window loses nothing. Rows with one id or text are different places;
equal texts of at least a window lose everything. Windows never cross documents. ``kept`` is binary, as a cut may divide a
character. ``n_spans`` counts the maximal removed runs of bytes. Other columns pass through in the struct ``row``. An empty table
gives an empty result. Buckets are dealt by id, text and partition of the input, so rows with one id, or none, spread.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from trailperks.llm.common import binary_list, shuffle_partitions, small_batches, text_bytes, with_row
from trailperks.llm.suffix_arrays import heads, ranges, suffix_arrays
from trailperks.llm.words import BYTE_BASE, byte_table, column_of, flat, lists, mixed, powers

#: Bytes in which a window's anchor is looked for.
GRAM = 48
#: Distinct strings of a family that one suffix array takes.
FAMILY = 16
BUCKET_BYTES, PART_BYTES = 4 * 2**20, 16 * 2**20
#: Bytes that are hashed at a time, and that suffix arrays take at a time.
SLICE, LANES = 2**20, 2**21
#: Windows that are compared, and rows of open windows that are sent, at a time.
COMPARED, SENT = 2**14, 2**16

PLACE_BITS = np.uint64(24)


@dataclass
class Strings:
    """Stretches of consecutive windows with one anchor: their place, their bytes and two hashes."""

    begins: np.ndarray
    lengths: np.ndarray
    families: np.ndarray
    hashes: np.ndarray


class Bucket:
    """The texts of a bucket, in the order of their bytes, one after the other."""

    def __init__(self, table: pa.Table, window: int, text: str):
        texts = binary_list(column_of(table, text)) if table.num_rows else []
        self.order = sorted(range(len(texts)), key=texts.__getitem__)
        self.texts = [texts[row] for row in self.order]
        self.ends = np.cumsum([len(value) for value in self.texts], dtype=np.int64)
        self.joined = b"".join(self.texts)
        self.bytes = np.frombuffer(self.joined, np.uint8)
        self.window = window

    def window_places(self) -> np.ndarray:
        """Whether a window starts at a place."""
        starts = np.ones(len(self.bytes), bool)
        sizes = np.diff(self.ends, prepend=0)
        short = np.minimum(sizes, self.window - 1)
        starts[ranges(self.ends - short, short)] = False
        return starts

    def strings(self) -> Iterator[Strings]:
        """All windows, as strings with one anchor."""
        starts = self.window_places()
        grams = self.window - GRAM + 1
        for low in range(0, len(self.bytes), SLICE):
            places = np.flatnonzero(starts[low : low + SLICE])
            if not len(places):
                continue
            data = self.bytes[low : low + SLICE + self.window]
            up, down = powers(BYTE_BASE, len(data) + 1)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(byte_table()[data] * up[:-1])])
            hashes = mixed((sums[GRAM:] - sums[:-GRAM]) * down[: len(sums) - GRAM])
            keys = (hashes >> PLACE_BITS << PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
            width = 1
            while width < grams:
                step = min(width, grams - width)
                keys = np.minimum(keys[:-step], keys[step:])
                width += step
            anchors = (keys[places] & np.uint64(2 ** int(PLACE_BITS) - 1)).astype(np.int64)
            new = np.ones(len(places), bool)
            new[1:] = (anchors[1:] != anchors[:-1]) | (places[1:] != places[:-1] + 1)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(places)) - 1
            begins, ends = places[first], places[last] + self.window
            whole = mixed((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64))
            yield Strings(begins + low, ends - begins, hashes[anchors[first]], whole)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(hashes) % np.uint64(parts)).astype(np.int64)


def grouped(owners: np.ndarray, **columns: tuple[np.ndarray, pa.DataType]) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """The distinct owners, and a list of the values of each."""
    order = np.argsort(owners, kind="stable")
    used, sizes = np.unique(owners, return_counts=True)
    return used, {name: lists(values[order], sizes, kind) for name, (values, kind) in columns.items()}


def rows_of(buckets: np.ndarray, kind: int, columns: dict[str, pa.Array]) -> pa.Table:
    return pa.table({"bucket": pa.array(buckets, pa.int32()), "kind": pa.array(np.full(len(buckets), kind), pa.int32())} | columns)


class Lanes:
    """Distinct strings side by side: those of one text of the suffix arrays (a lane) have one ``keys`` value."""

    def __init__(self, strings: list[bytes], keys: np.ndarray, window: int):
        self.window = window
        sizes = np.array([len(value) for value in strings], np.int64)
        self.ends = np.cumsum(sizes + 1) - 1  # of the strings; a separator follows each
        self.begins = self.ends - sizes
        self.data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        self.owners = np.repeat(np.arange(len(strings), dtype=np.int32), sizes + 1)
        # Separators are smaller than bytes; the one that ends a lane is smaller than all and occurs there only.
        symbols = self.data.astype(np.uint16) + np.uint16(2)
        symbols[self.ends] = 1
        self.lane_ends = self.ends[np.append(heads(keys)[1:], len(keys)) - 1] + 1
        symbols[self.lane_ends - 1] = 0
        self.symbols = symbols

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts of windows in the order of the suffix arrays, and the rows at which a new window begins."""
        suffixes = suffix_arrays(self.symbols, self.lane_ends)
        starts = suffixes[self.ends[self.owners[suffixes]] - suffixes >= self.window]
        lanes = np.searchsorted(self.lane_ends, starts, side="right")
        new = np.ones(len(starts), bool)
        new[1:] = lanes[1:] != lanes[:-1]
        windows = np.lib.stride_tricks.sliding_window_view(self.data, self.window)
        for low in range(1, len(starts), COMPARED):
            high = min(low + COMPARED, len(starts))
            new[low:high] |= (windows[starts[low:high]] != windows[starts[low - 1 : high - 1]]).any(axis=1)
        return starts, np.flatnonzero(new)


class Family:
    """The strings that a part has received, and where they come from."""

    def __init__(self, table: pa.Table):
        names = table["string"].to_pylist()
        families = table["family"].to_numpy().view(np.uint64)
        numbers: dict[tuple[int, bytes], int] = {}
        rows = np.array([numbers.setdefault(pair, len(numbers)) for pair in zip(families.tolist(), names)], np.int64)
        # Short lanes go together, as suffix arrays take as many steps as the longest lane.
        distinct = list(numbers)
        salt = np.zeros(len(distinct), np.int64)
        salt[rows] = table["salt"].to_numpy()
        keys = mixed(np.array([pair[0] for pair in distinct], np.uint64) + salt.astype(np.uint64) * np.uint64(BYTE_BASE))
        _, lane, counts = np.unique(keys, return_inverse=True, return_counts=True)
        order = np.lexsort((keys, counts[lane]))
        self.strings = [distinct[at][1] for at in order.tolist()]
        self.keys, self.salted = keys[order], salt[order] >= 0
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        starts, sizes = flat(table["starts"])
        self.owner = np.repeat(place[rows], sizes)  # the string of each occurrence
        self.bucket = np.repeat(table["bucket"].to_numpy(), sizes)
        self.start = starts.astype(np.int64)
        self.weights = np.bincount(self.owner, minlength=len(order))
        first = np.argsort(self.owner, kind="stable")
        self.first = first[np.searchsorted(self.owner[first], np.arange(len(order)))]  # one occurrence of each string

    def slices(self) -> Iterator[tuple[int, int]]:
        """Ranges of whole lanes with about ``LANES`` bytes each."""
        lanes = heads(self.keys)
        sizes = np.array([len(value) + 1 for value in self.strings], np.int64)
        begin = total = 0
        for lane, size in zip(lanes.tolist(), np.add.reduceat(sizes, lanes).tolist()):
            if total and total + size > LANES:
                yield begin, lane
                begin, total = lane, 0
            total += size
        yield begin, len(self.keys)


def remove_repeated(docs: DataFrame, window: int = 200, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept): a row per document."""
    if window <= GRAM:
        raise ValueError(f"windows must be longer than {GRAM} bytes")
    spark = docs.sparkSession
    small_batches(spark)
    size = text_bytes(docs, text)
    partitions = shuffle_partitions(spark)
    buckets, parts = max(partitions, -(-size // BUCKET_BYTES)), max(partitions, -(-size // PART_BYTES))

    def number(table: pa.Table) -> int:
        return table["bucket"][0].as_py()

    def send_families(table: pa.Table) -> pa.Table:
        """The hash of each family in the bucket, its distinct strings, and whether it occurs again in the bucket."""
        found = list(Bucket(table, window, text).strings())
        families = np.concatenate([np.empty(0, np.uint64), *(s.families for s in found)])
        hashes = np.concatenate([np.empty(0, np.uint64), *(s.hashes for s in found)])
        order = np.lexsort((hashes, families))
        families, hashes = families[order], hashes[order]
        first, strings = heads(families), heads(families, hashes)
        distinct = np.diff(np.append(np.searchsorted(strings, first), len(strings)))
        counts = np.diff(np.append(first, len(families)))
        used, columns = grouped(
            part_of(families[first], parts),
            family=(families[first].view(np.int64), pa.int64()),
            distinct=(distinct.astype(np.int32), pa.int32()),
            again=(counts > 1, pa.bool_()),
        )
        return pa.table({"part": pa.array(used, pa.int32()), "bucket": pa.array(np.full(len(used), number(table)), pa.int32())} | columns)

    def repeated(table: pa.Table) -> pa.Table:
        """The families of each bucket that occur again anywhere, and to how many suffix arrays they are dealt."""
        families, sizes = flat(table["family"])
        distinct, _ = flat(table["distinct"])
        again, _ = flat(table["again"])
        owners = np.repeat(table["bucket"].to_numpy(), sizes)
        known, inverse, counts = np.unique(families, return_inverse=True, return_counts=True)
        often = counts > 1
        often[inverse[again.astype(bool)]] = True
        strings = np.bincount(inverse, weights=distinct, minlength=len(known)).astype(np.int64)
        salts = np.maximum(1, -(-strings // FAMILY))
        pick = often[inverse]
        used, columns = grouped(
            owners[pick], family=(families[pick], pa.int64()), salts=(salts[inverse[pick]].astype(np.int32), pa.int32())
        )
        return pa.table({"bucket": pa.array(used, pa.int32())} | columns)

    def send_strings(table: pa.Table, answers: pa.Table) -> pa.Table:
        """Each distinct string of a family that occurs again, with its places in the bucket."""
        known, salts = np.empty(0, np.uint64), np.empty(0, np.int32)
        if answers.num_rows:
            known, salts = flat(answers["family"])[0].view(np.uint64), flat(answers["salts"])[0]
            order = np.argsort(known)
            known, salts = known[order], salts[order]
        bucket = Bucket(table, window, text)
        places: dict[tuple[int, bytes], list[int]] = {}
        for found in bucket.strings():
            at = np.searchsorted(known, found.families)
            at[at == len(known)] = 0
            for row in np.flatnonzero(known[at] == found.families).tolist() if len(known) else ():
                begin = int(found.begins[row])
                string = bucket.joined[begin : begin + int(found.lengths[row])]
                places.setdefault((int(at[row]), string), []).append(begin)
        rows = np.array([at for at, _ in places], np.int64)
        family, dealt = known[rows], salts[rows].astype(np.int64)
        hashes = np.array([xxhash.xxh64_intdigest(string) for _, string in places], np.uint64)
        salt = np.where(dealt > 1, (hashes % np.maximum(dealt, 1).astype(np.uint64)).astype(np.int64), -1)
        return pa.table(
            {
                "part": pa.array(part_of(family + (salt + 1).astype(np.uint64) * np.uint64(BYTE_BASE), parts), pa.int32()),
                "bucket": pa.array(np.full(len(places), number(table) if len(places) else 0), pa.int32()),
                "family": pa.array(family.view(np.int64)),
                "salt": pa.array(salt, pa.int32()),
                "string": pa.array([string for _, string in places], pa.binary()),
                "starts": pa.array(list(places.values()), pa.list_(pa.int32())),
            }
        )

    def search(table: pa.Table) -> pa.Table:
        """Places of repeated windows by bucket (kind 0), and the distinct windows of families in several parts (kind 1)."""
        family = Family(table)
        out = []
        occurrences = np.argsort(family.owner, kind="stable")
        for low, high in family.slices():
            lanes = Lanes(family.strings[low:high], family.keys[low:high], window)
            starts, first = lanes.classes()
            strings = lanes.owners[starts]
            sizes = np.diff(np.append(first, len(starts)))
            weights = np.add.reduceat(family.weights[low + strings], first) if len(first) else np.empty(0, np.int64)
            again = np.zeros(len(lanes.data), bool)
            again[starts[np.repeat(weights > 1, sizes)]] = True
            # Stretches of repeated windows, and each string's occurrences.
            edges = np.flatnonzero(np.diff(np.concatenate([[False], again, [False]]).astype(np.int8)))
            begins, ends = edges[::2], edges[1::2]
            of = lanes.owners[begins]
            mine = occurrences[slice(*np.searchsorted(family.owner[occurrences], (low, high)))]
            runs_from, runs_to = (np.searchsorted(of, family.owner[mine] - low, side) for side in ("left", "right"))
            runs = ranges(runs_from, runs_to - runs_from)
            at = np.repeat(mine, runs_to - runs_from)
            shift = family.start[at] - lanes.begins[of[runs]]
            used, columns = grouped(
                family.bucket[at],
                one=(shift + begins[runs], pa.int64()),
                two=(shift + ends[runs] - 1 + window, pa.int64()),
                place=(np.zeros(len(at), np.int32), pa.int32()),
            )
            out.append(rows_of(used, 0, columns))
            # One of each distinct window of a family that other parts have too.
            open_ = np.flatnonzero(family.salted[low + strings[first]])
            for begin in range(0, len(open_), SENT):
                chosen = open_[begin : begin + SENT]
                at = starts[first[chosen]]
                digests = b"".join(xxhash.xxh3_128_digest(lanes.data[a : a + window].tobytes()) for a in at.tolist())
                pair = np.frombuffer(digests, np.int64).reshape(-1, 2)
                where = family.first[low + lanes.owners[at]]
                single = weights[chosen] == 1
                place = np.where(single, family.start[where] + at - lanes.begins[lanes.owners[at]], -1)
                used, columns = grouped(
                    family.bucket[where],
                    one=(pair[:, 0], pa.int64()),
                    two=(pair[:, 1], pa.int64()),
                    place=(place.astype(np.int32), pa.int32()),
                )
                out.append(rows_of(used, 1, columns))
        return pa.concat_tables(out)

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        bucket = Bucket(table, window, text)
        change = np.zeros(len(bucket.bytes) + 1, np.int32)
        if answers.num_rows:
            np.add.at(change, flat(answers["begins"])[0], 1)
            np.add.at(change, flat(answers["ends"])[0], -1)
        gone = np.cumsum(change)[:-1] > 0
        kept, removed, spans = [], [], []
        for value, end in zip(bucket.texts, bucket.ends.tolist()):
            mask = gone[end - len(value) : end]
            removed.append(int(mask.sum()))
            spans.append(int(np.count_nonzero(np.diff(mask.astype(np.int8), prepend=0) == 1)))
            kept.append(np.frombuffer(value, np.uint8)[~mask].tobytes() if removed[-1] else value)
        return pa.table(
            {
                "row": table["row"].combine_chunks().take(pa.array(bucket.order, pa.int64())),
                "n_bytes": pa.array([len(value) for value in bucket.texts], pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(spans, pa.int64()),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    spread = F.xxhash64(F.lit(12), F.col(doc_id), F.col(text), F.spark_partition_id())
    dealt = docs.select(F.pmod(spread, F.lit(buckets)).cast("int").alias("bucket"), F.struct("*").alias("row"))
    texts = dealt.groupBy("bucket")
    families = texts.applyInArrow(send_families, "part int, bucket int, family array<bigint>, distinct array<int>, again array<boolean>")
    often = families.groupBy("part").applyInArrow(repeated, "bucket int, family array<bigint>, salts array<int>")
    strings = texts.cogroup(often.groupBy("bucket")).applyInArrow(
        send_strings, "part int, bucket int, family bigint, salt int, string binary, starts array<int>"
    )
    found = strings.groupBy("part").applyInArrow(
        search, "bucket int, kind int, one array<bigint>, two array<bigint>, place array<int>"
    )
    # The function keeps filters and columns above the exchange, so that its three readers share it.
    found = found.repartition(parts, "bucket").mapInArrow(lambda batches: batches, found.schema)
    windows = found.where("kind = 1").select("bucket", F.explode(F.arrays_zip("one", "two", "place")).alias("w")).select("bucket", "w.*")
    again = (
        windows.groupBy("one", "two").agg(F.sum(F.when(F.col("place") < 0, 2).otherwise(1)).alias("n")).where("n > 1").drop("n")
    )
    late = windows.where("place >= 0").join(again, ["one", "two"]).select(
        "bucket", F.array(F.col("place").cast("long")).alias("begins"), F.array(F.col("place").cast("long") + window).alias("ends")
    )
    places = found.where("kind = 0").select("bucket", F.col("one").alias("begins"), F.col("two").alias("ends")).unionByName(late)
    return texts.cogroup(places.groupBy("bucket")).applyInArrow(
        remove, with_row(dealt, "n_bytes long, n_removed long, n_spans long, kept binary")
    )
