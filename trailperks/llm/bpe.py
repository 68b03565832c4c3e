"""Byte-level BPE: distinct words are folded by higher-order functions, texts are put together from them.

The words of a text are the matches of the vocabulary's pattern. Each task packs its documents, as they come, into buckets of
about ``BUCKET_BYTES`` of text, squeezed, and only these move. A bucket sends its distinct units, a blank or line end and what
follows it up to the next (see :mod:`trailperks.llm.encoding`), known by 64-bit hashes and dealt by ranges of these, so that each
unit of the corpus arrives once per bucket, however often it occurs. There the pattern splits the distinct units into words, and a
word's bytes, an array of binary pieces, are folded: each step merges the leftmost pair of the lowest rank and looks up the
ranks of the two pairs that this makes in a literal map, until no pair has a rank. The ids go back to the buckets in the order
of the units, and the ids of whole texts are gathered from them. The literal map has the vocabulary's size, whatever the data.

Texts with odd white space are split by the pattern at once; their words are units of their own.

A fold takes time with the square of the word's length, so words over ``LONG_WORD`` bytes are merged with a heap instead, to the
same result.

Decoding concatenates the binary pieces of the ids.

Defined results: a null text is empty and has no ids. Special tokens in a text are ordinary text. Repeated rows and null ids
are documents like any other. Extra columns pass through in the struct ``row``. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from trailperks.llm.common import binary_list, field_of, shuffle_partitions, slices, small_batches, text_bytes, with_row
from trailperks.llm.encoding import FIRST, ODD_SPACES, words_at
from trailperks.llm.words import hash_joined

BUCKET_BYTES, PART_BYTES, SLICE_BYTES = 8 * 1024**2, 6 * 1024**2, 1024**2
LONG_WORD = 48
SLOTS = 2**14


@lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def rank_map(path: str) -> Column:
    """The ranks as a literal: an array of small maps from a piece's hex digits, found by the piece's CRC."""
    slots: list[dict[str, int]] = [{} for _ in range(SLOTS)]
    for piece, rank in ranks_of(path).items():
        slots[zlib.crc32(piece) % SLOTS][piece.hex().upper()] = rank
    return F.from_json(F.lit(json.dumps(slots, separators=(",", ":"))), "array<map<string,int>>")


def rank(ranks: Column, piece: Column) -> Column:
    """The rank of a binary piece, or null."""
    slot = F.element_at(ranks, (F.crc32(piece) % SLOTS + 1).cast("int"))
    return F.try_element_at(slot, F.hex(piece))


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def merge_once(ranks: Column, pieces: Column) -> Column:
    """The pieces, each with the rank of the pair that it makes with the next, with their best pair merged, or as they are."""
    of_pairs = pieces["rank"]
    # Of pairs of the same rank, the position is that of the leftmost.
    best = (F.array_position(of_pairs, F.array_min(of_pairs)) - 1).cast("int")

    def merged(at: Column) -> Column:
        """The pieces with the pair at this place, from 0, merged."""

        def with_pair(pair: Column) -> Column:
            # Without a neighbour a pair is null, and so is its rank.
            before, after = F.get(pieces, at - 1)["piece"], F.get(pieces, at + 2)["piece"]
            new = F.struct(pair.alias("piece"), rank(ranks, F.concat(pair, after)).alias("rank"))
            left = F.struct(before.alias("piece"), rank(ranks, F.concat(before, pair)).alias("rank"))
            return F.concat(
                F.slice(pieces, F.lit(1), F.greatest(at - 1, F.lit(0))),
                F.when(at > 0, F.array(left, new)).otherwise(F.array(new)),
                F.slice(pieces, at + 3, F.size(pieces)),
            )

        return bind(F.concat(F.get(pieces, at)["piece"], F.get(pieces, at + 1)["piece"]), with_pair)

    return bind(best, lambda at: F.when(at.isNull(), pieces).otherwise(merged(at)))


def fold(ranks: Column, word: Column) -> Column:
    """The ids of a binary word."""
    size = F.octet_length(word)

    def single(n: Column) -> Column:
        pair = F.when(n < size, F.substring(word, n, F.lit(2)))
        return F.struct(F.substring(word, n, F.lit(1)).alias("piece"), rank(ranks, pair).alias("rank"))

    folded = F.aggregate(
        F.sequence(F.lit(2), F.greatest(size, F.lit(2))),
        F.transform(F.sequence(F.lit(1), size), single),
        lambda pieces, _: merge_once(ranks, pieces),
        lambda pieces: pieces["piece"],
    )
    return bind(
        rank(ranks, word),
        lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(folded, lambda piece: rank(ranks, piece))),
    )


def merge_with_heap(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges in time with the length times its logarithm."""
    if word in ranks:
        return [ranks[word]]
    pieces: list[bytes | None] = [word[n : n + 1] for n in range(len(word))]
    after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
    heap = []

    def offer(left: int) -> None:
        right = after[left]
        if left >= 0 and right < len(pieces):
            pair = pieces[left] + pieces[right]
            if pair in ranks:
                heapq.heappush(heap, (ranks[pair], left, right, pair))

    for n in range(len(word) - 1):
        offer(n)
    while heap:
        _, left, right, pair = heapq.heappop(heap)
        if pieces[left] is None or pieces[right] is None or after[left] != right or pieces[left] + pieces[right] != pair:
            continue
        pieces[left], pieces[right], after[left] = pair, None, after[right]
        if after[right] < len(pieces):
            before[after[right]] = left
        offer(left)
        if before[left] >= 0:
            offer(before[left])
    return [ranks[piece] for piece in pieces if piece is not None]


def squeezed(lengths: np.ndarray, values: bytes) -> bytes:
    """Values of several lengths as one small piece."""
    data = np.array([len(lengths)], "<u4").tobytes() + lengths.astype("<u4").tobytes() + values
    return np.array([len(data)], "<u8").tobytes() + pa.Codec("zstd", compression_level=3).compress(data, asbytes=True)


def unsqueezed(piece: bytes) -> tuple[np.ndarray, bytes]:
    size = int(np.frombuffer(piece, "<u8", 1)[0])
    data = pa.decompress(piece[8:], decompressed_size=size, codec="zstd", asbytes=True)
    count = int(np.frombuffer(data, "<u4", 1)[0])
    return np.frombuffer(data, "<u4", count, 4), data[4 + 4 * count :]


def words_in(piece: bytes) -> list[bytes]:
    lengths, joined = unsqueezed(piece)
    ends = np.cumsum(lengths, dtype=np.int64).tolist()
    return [joined[a:b] for a, b in zip([0, *ends], ends)]


def gathered(values: np.ndarray, sizes: np.ndarray, begins: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The values of the lists with these numbers, one after the other."""
    lengths = sizes[at]
    return values[np.repeat(begins[at] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())]


def numbers(values) -> bytes:
    return np.asarray(values, np.int32).tobytes()


class Units:
    """The distinct units of a bucket in the order of their hashes, and the unit at each place of its texts."""

    def __init__(self, texts: list[str], compiled: regex.Pattern):
        odd = {n: compiled.findall(text) for n, text in enumerate(texts) if ODD_SPACES.search(text)}
        marked = [FIRST + text.encode().replace(b"\n", b" \n") for n, text in enumerate(texts) if n not in odd]
        self.joined = b" ".join(marked)
        self.counts = np.zeros(len(texts), np.int64)
        self.counts[list(odd)] = [len(found) for found in odd.values()]
        is_odd = np.zeros(len(texts), bool)
        is_odd[list(odd)] = True
        self.counts[~is_odd] = [text.count(b" ") + 1 for text in marked]
        hashes, self.firsts, places = np.unique(hash_joined(self.joined), return_index=True, return_inverse=True)
        self.own = sorted({word.encode() for found in odd.values() for word in found})
        self.hashes = np.concatenate([hashes, np.array([xxhash.xxh64_intdigest(word, 3) for word in self.own], np.uint64)])
        self.order = np.argsort(self.hashes, kind="stable")
        self.hashes, turned = self.hashes[self.order], np.empty(len(self.order), np.int32)
        turned[self.order] = np.arange(len(self.order), dtype=np.int32)
        at = {word.decode(): n for n, word in enumerate(self.own, len(hashes))}
        self.places = np.empty(self.counts.sum(), np.int32)
        from_odd = np.repeat(is_odd, self.counts)
        self.places[~from_odd] = turned[places]
        self.places[from_odd] = turned[np.array([at[word] for found in odd.values() for word in found], np.int64)]

    def words(self) -> list[bytes]:
        plain = words_at(self.joined, self.firsts) if self.joined else []
        all_words = [word[1:] if word[:1] == FIRST else word if word[:1] == b"\n" else b" " + word for word in plain] + self.own
        return [all_words[n] for n in self.order.tolist()]


def packed(rows: list[pa.RecordBatch]) -> bytes:
    """Batches of one schema, squeezed."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))) as out:
        for batch in rows:
            out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, ids): the ids of each text as little-endian 32-bit integers."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = max(shuffle_partitions(spark), -(-text_bytes(docs, text) // PART_BYTES))
    narrow = "<u2" if max(ranks_of(path).values(), default=0) < 2**16 else "<u4"  # of ids on their way

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Buckets of the rows of a task in their order, numbered in the bits below the task's number."""
        rows, size, number = [], 0, None

        def bucket() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([packed(rows)], pa.binary())], names=["bucket", "rows"])

        for batch in batches:
            for begin, end in slices(field_of(batch.column(1), text), SLICE_BYTES):
                if not rows:
                    number = batch.column(0)[0].as_py() << 32 if number is None else number + 1
                rows.append(batch.slice(begin, end - begin).select(["row"]))
                size += rows[-1].nbytes
                if size >= BUCKET_BYTES:
                    yield bucket()
                    rows, size = [], 0
        if rows:
            yield bucket()

    def unpacked(table: pa.Table) -> tuple[pa.Table, Units]:
        rows = pa.ipc.open_stream(table["rows"][0].as_py()).read_all()
        texts = [x or "" for chunk in rows["row"].chunks for x in field_of(chunk, text).to_pylist()]
        return rows, Units(texts, regex.compile(pattern))

    def send_units(table: pa.Table) -> pa.Table:
        _, units = unpacked(table)
        words = units.words()
        part = ((units.hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        used, begins = np.unique(part, return_index=True)
        own = [words[a:b] for a, b in zip(begins.tolist(), [*begins.tolist()[1:], len(words)])]
        return pa.table(
            {
                "part": pa.array(used, pa.int32()),
                "bucket": pa.array([table["bucket"][0].as_py()] * len(used), pa.int64()),
                "units": pa.array([squeezed(np.array([len(w) for w in x], np.int64), b"".join(x)) for x in own], pa.binary()),
            }
        )

    def distinct(table: pa.Table) -> pa.Table:
        """One row: the distinct words of a part, long ones with their ids, the words of each unit, and the units each bucket asks for."""
        number: dict[bytes, int] = {}
        asked = [numbers([number.setdefault(x, len(number)) for x in words_in(piece.as_py())]) for piece in table["units"]]
        split = [[word.encode() for word in regex.findall(pattern, unit.decode())] for unit in number]
        known: dict[bytes, int] = {}
        at = [known.setdefault(word, len(known)) for found in split for word in found]
        ranks = ranks_of(path)
        long = [merge_with_heap(w, ranks) if len(w) > LONG_WORD else [] for w in known]
        row = {
            "part": (table["part"][0].as_py(), pa.int32()),
            "short": ([w if len(w) <= LONG_WORD else b"" for w in known], pa.list_(pa.binary())),
            "long": (numbers([x for ids in long for x in ids]), pa.binary()),
            "long_sizes": (numbers([len(ids) for ids in long]), pa.binary()),
            "words": (numbers(at), pa.binary()),
            "word_counts": (numbers([len(found) for found in split]), pa.binary()),
            "buckets": (table["bucket"].to_pylist(), pa.list_(pa.int64())),
            "asked": (asked, pa.list_(pa.binary())),
        }
        return pa.table({name: pa.array([value], kind) for name, (value, kind) in row.items()})

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, *blobs = (batch.column(n)[row].as_py() for n in (0, 2, 3, 4, 5))
                long, long_sizes, words, word_counts = (np.frombuffer(x, np.int32) for x in blobs)
                short = batch.column(1).slice(row, 1).flatten()
                short_sizes = np.diff(short.offsets.to_numpy()).astype(np.int64)
                # The ids of each word: those of the short words, then those of the long ones.
                values = np.concatenate([short.flatten().to_numpy(zero_copy_only=False), long]).astype(np.int32)
                begins = np.where(
                    long_sizes > 0, short_sizes.sum() + np.cumsum(long_sizes) - long_sizes, np.cumsum(short_sizes) - short_sizes
                )
                sizes = short_sizes + long_sizes
                of_units = gathered(values, sizes, begins, words)
                ends = np.concatenate([[0], np.cumsum(sizes[words])])
                unit_ends = ends[np.cumsum(word_counts, dtype=np.int64)]
                unit_begins = np.concatenate([[0], unit_ends])[:-1]
                unit_sizes = unit_ends - unit_begins
                for bucket, asked in zip(batch.column(6)[row].as_py(), batch.column(7)[row].as_py()):
                    at = np.frombuffer(asked, np.int32)
                    ids = gathered(of_units, unit_sizes, unit_begins, at).astype(narrow)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([bucket], pa.int64()), pa.array([part], pa.int32()), pa.array([squeezed(unit_sizes[at], ids.tobytes())], pa.binary())],
                        names=["bucket", "part", "ids"],
                    )

    def assemble(table: pa.Table, replies: pa.Table) -> pa.Table:
        rows, units = unpacked(table)
        found = [unsqueezed(piece.as_py()) for piece in replies.sort_by("part")["ids"]]
        sizes = np.concatenate([x for x, _ in found]).astype(np.int64) if found else np.empty(0, np.int64)
        values = np.frombuffer(b"".join(x for _, x in found), narrow)
        begins, out, text_at, unit_at = np.cumsum(sizes) - sizes, [], 0, 0
        for chunk in rows["row"].chunks:
            counts = units.counts[text_at : text_at + len(chunk)]
            at = units.places[unit_at : unit_at + counts.sum()]
            ids = gathered(values, sizes, begins, at).astype("<u4")
            text_ends = np.concatenate([[0], np.cumsum(sizes[at])])[np.concatenate([[0], np.cumsum(counts)])] * 4
            buffers = [None, pa.py_buffer(text_ends.astype(np.int32).tobytes()), pa.py_buffer(ids.tobytes())]
            out.append(pa.table({"row": chunk, "ids": pa.Array.from_buffers(pa.binary(), len(chunk), buffers)}))
            text_at, unit_at = text_at + len(chunk), unit_at + len(at)
        return pa.concat_tables(out)

    rows = docs.select(F.spark_partition_id().alias("task"), F.struct("*").alias("row"))
    texts = rows.mapInArrow(pack, "bucket bigint, rows binary").groupBy("bucket")
    words = texts.applyInArrow(send_units, "part int, bucket bigint, units binary").groupBy("part").applyInArrow(
        distinct,
        "part int, short array<binary>, long binary, long_sizes binary, words binary, word_counts binary, "
        "buckets array<bigint>, asked array<binary>",
    )

    def fold_all(ranks: Column) -> Column:
        none = F.array().cast("array<int>")
        return F.transform("short", lambda word: F.when(F.octet_length(word) > 0, fold(ranks, word)).otherwise(none))

    # Bound, the literal is in the plan, and in each task, once and not at every lookup.
    folded = bind(rank_map(path), fold_all)
    ids = words.withColumn("short", folded).mapInArrow(answers, "bucket bigint, part int, ids binary")
    return texts.cogroup(ids.groupBy("bucket")).applyInArrow(assemble, with_row(rows, "ids binary"))


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` (all columns in a struct ``row``) with the bytes that its ids stand for."""
    rows = encoded.select(F.struct("*").alias("row"), F.col(ids).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = sorted(ranks_of(path), key=ranks_of(path).get).__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [b"".join(map(pieces, np.frombuffer(x or b"", "<u4").tolist())) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], names=["row", "decoded"])

    return rows.mapInArrow(run, with_row(rows, "decoded binary"))
