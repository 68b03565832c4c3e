"""Language model scoring with a hierarchical Pitman-Yor process.

Every training word is a context, and so is the beginning of a text. A token is a customer of the restaurant of its context,
the word before it; all these restaurants share one parent, the restaurant of single words, whose base is uniform over the
V training words and one for all others. Seating is sampled by Gibbs sweeps over the numbers of tables: given everything
else, the number of tables of a word in a restaurant is drawn from its exact conditional distribution (generalised Stirling
numbers) up to ``EXACT`` customers, beyond by seating its customers in turn. A table of a context's restaurant is a customer
of the parent. The predictive probabilities of ``SAMPLES`` sweeps after ``BURN_IN`` are averaged, and a text's score is the
sum of the log10 of these.

Documents are dealt to buckets of about ``BUCKET_BYTES`` of text. A bucket sends each distinct (context, word) once, with its
training count, to the part of the context (contexts by 64-bit hash), so a pair with a third of all tokens is one entry per
bucket, and a restaurant lies in one part as a whole. Only the restaurants of the ``CONTEXTS`` most frequent words and of the
beginning, which may be as large as the table, are spread over all parts by the hash of the word. ``CONTEXTS`` = 0 gives
contexts a discount of one, which sends every customer to the parent: a model of single words.

The parent's words have homes, again by hash. In each of the ``ROUNDS`` parts tell the homes what customers they send, homes seat
these in the parent and tell the parts, which make as many sweeps; meanwhile other parts and the parent's tables stay as
they were told. Only pairs with several customers are seated, all others have one table. The predictive probabilities
use the exact totals of the sampled seatings and sum to one. They go back to the buckets, in the order asked, with the training
count of each context, which is the number of its customers.

The most frequent words are found by the exact counts of all training words: each task sends the count of every word it met, in
several parts if there are more than ``COUNTED`` at a time.

Defined results: a null text is empty; every text has one end token. A text without training documents is scored with
V = N = 0. Repeated rows and null ids are documents like any other. Extra columns pass through in the struct ``row``. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from trailperks.llm.common import binary_list, discard, keep, settings, shuffle_partitions, small_batches, text_bytes, with_row
from trailperks.llm.words import Words, column_of, flat, hash_joined, lists, mixed, words_of

BUCKET_BYTES, PART_BYTES, HOME_BYTES = 12 * 1024**2, 12 * 1024**2, 64 * 1024**2
CONTEXTS, COUNTED = 32, 2**18
BURN_IN, SAMPLES = 3, 3
ROUNDS = (1,) * BURN_IN + (SAMPLES,)  # sweeps between exchanges
DISCOUNT, STRENGTH = (0.7, 0.8), (1.0, 1.0)  # of the parent, of a context
EXACT = 64
# Frames that are computed once leave no shuffle files behind; rows as large as parts go to Python one or a few at a time.
ONCE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "4194304"}
END = np.uint64(0)


def frequent_words(texts: DataFrame) -> list[bytes]:
    """The words whose restaurants are spread over all parts, most frequent first, ties to the smaller word."""

    def sent(counts: Counter[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in binary_list(batch.column(0)):
                counts.update(text.lower().split())
                if len(counts) > COUNTED:
                    yield sent(counts)
                    counts.clear()
        yield sent(counts)

    summed = texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [bytes(row.word) for row in summed.orderBy(F.desc("n"), "word").limit(CONTEXTS).collect()]


class Tokens:
    """The tokens of a bucket: the distinct pairs of a context and a word, by context, and the pair of each token.

    The context of a token is the hash of the word before it, ``END`` at the beginning of a text. If ``contexts`` are given,
    it is the number of the last of these words before it, from one, and zero if there is none.
    """

    def __init__(self, texts: list[bytes], contexts: list[bytes] | None = None):
        words: Words = words_of([text.lower() for text in texts])
        self.counts = words.counts + 1
        self.firsts = np.cumsum(self.counts) - self.counts
        hashes = np.insert(words.hashes, np.cumsum(words.counts), END)
        known, numbers = np.unique(hashes, return_inverse=True)
        if contexts is None:
            # The end of the text before, which is the smallest hash, stands for the beginning.
            names, keys = known, np.zeros(len(numbers), np.int64)
            keys[1:] = numbers[:-1]
        else:
            names, keys = np.arange(len(contexts) + 1, dtype=np.uint64), self.last_of(contexts, hashes)
        del hashes
        keys *= len(known)
        keys += numbers
        del numbers
        pairs, self.pairs = np.unique(keys, return_inverse=True)
        self.words, self.contexts = known[pairs % max(1, len(known))], names[pairs // max(1, len(known))]

    def last_of(self, contexts: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """The number of the last context word strictly before each token, in the same document."""
        number = np.zeros(len(hashes), np.int64)
        for n, word in enumerate(contexts, 1):
            number[hashes == hash_joined(word)[0]] = n
        places = np.where(number > 0, np.arange(len(hashes)), -1)
        last = np.concatenate([[-1], np.maximum.accumulate(places)])[: len(hashes)]
        return np.where(last >= np.repeat(self.firsts, self.counts), number[last], 0)

    def training_counts(self, training: np.ndarray) -> np.ndarray:
        return np.bincount(self.pairs, np.repeat(training, self.counts), minlength=len(self.words)).astype(np.int64)


@lru_cache(maxsize=4)
def log_stirling(discount: float) -> np.ndarray:
    """log S(c, t) of the generalised Stirling numbers, for c and t up to ``EXACT``."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[1, 1] = 0.0
    for c in range(1, EXACT):
        with np.errstate(divide="ignore"):
            stay = out[c, 1 : c + 2] + np.log(np.maximum(c - discount * np.arange(1, c + 2), 0))
        out[c + 1, 1 : c + 2] = np.logaddexp(stay, out[c, : c + 1])
    return out


def seat(counts: np.ndarray, base: np.ndarray, others: np.ndarray, discount: float, strength: float, random) -> np.ndarray:
    """Numbers of tables drawn for words with these customers, base probabilities and tables of other words."""
    tables = (counts > 0).astype(np.int64)
    stirling = log_stirling(discount)
    several = np.flatnonzero((counts > 1) & (counts <= EXACT))
    for c in np.unique(counts[several]).tolist():
        chosen = several[counts[several] == c]
        for begin in range(0, len(chosen), 2**20 // c):
            rows = chosen[begin : begin + 2**20 // c]
            opened = np.log(strength + discount * (others[rows, None] + np.arange(c))) + np.log(base[rows, None])
            weights = np.cumsum(opened, axis=1, out=opened)
            weights += stirling[c, 1 : c + 1]
            weights -= weights.max(axis=1, keepdims=True)
            np.cumsum(np.exp(weights, out=weights), axis=1, out=weights)
            tables[rows] = 1 + (weights <= weights[:, -1:] * random.random((len(rows), 1))).sum(axis=1)
    rows = np.flatnonzero(counts > EXACT)
    if len(rows):
        rows = rows[np.argsort(-counts[rows], kind="stable")]
        weight = (strength + discount * others[rows]) * base[rows]
        total, found, n = counts[rows], np.ones(len(rows)), 1
        while n < total[0]:
            # One customer at a time at first; then in groups that are small against those seated.
            step = max(1, n // 32)
            going = np.searchsorted(-total, -n, side="left")
            group = np.minimum(step, total[:going] - n)
            chance = weight[:going] / (n - discount * found[:going] + weight[:going])
            found[:going] += random.binomial(group, np.clip(chance, 0, 1))
            n += step
        tables[rows] = np.minimum(found, total).astype(np.int64)
    return tables


@dataclass
class Outside:
    """What a part is told: customers and tables of its words in the parent, those of all words, the number of known words, and the
    tables of each of its contexts that are not of its pairs."""

    customers: np.ndarray
    tables: np.ndarray
    all_customers: int
    all_tables: int
    known: int
    of_contexts: np.ndarray


def seatings(
    words: np.ndarray, contexts: np.ndarray, counts: np.ndarray, parts: int, random, outside: Outside | None = None,
    tables: np.ndarray | None = None, sweeps: int = BURN_IN + SAMPLES, discount: float = DISCOUNT[1],
) -> list[tuple]:
    """(tables of each pair, parent customers and parent tables of each word) of the last ``SAMPLES`` sweeps, from ``tables`` on.

    ``words`` and ``contexts`` number the word and the context of each pair. Without ``outside`` the parent is seated too, and totals
    over all parts are taken as ``parts`` times those of this one.
    """
    number = int(words.max()) + 1 if len(words) else 0
    restaurants = int(contexts.max()) + 1 if len(contexts) else 0
    tables = np.minimum(counts, 1) if tables is None else tables
    told = customers = np.bincount(words, tables, minlength=number).astype(np.int64)
    parent_tables = np.minimum(customers, 1) if outside is None else outside.tables
    uniform = np.full(number, 1 / ((parent_tables.sum() * parts if outside is None else outside.known) + 1))
    kept = []
    for _ in range(sweeps):
        everywhere = np.bincount(contexts, tables, minlength=restaurants).astype(np.int64)
        if outside is None:
            everywhere *= parts
            parent = predictive(customers, parent_tables, customers.sum() * parts, parent_tables.sum() * parts, uniform, 0)
        else:
            everywhere += outside.of_contexts
            grown = customers - told
            parent = predictive(
                outside.customers + grown, parent_tables, outside.all_customers + grown.sum(), outside.all_tables, uniform, 0
            )
        tables = seat(counts, parent[words], np.maximum(everywhere[contexts] - tables, 0), discount, STRENGTH[1], random)
        customers = np.bincount(words, tables, minlength=number).astype(np.int64)
        if outside is None:
            others = np.maximum(parent_tables.sum() * parts - parent_tables, 0)
            parent_tables = seat(customers, uniform, others, DISCOUNT[0], STRENGTH[0], random)
        kept.append((tables, customers, parent_tables))
    return kept[-SAMPLES:]


def parent_seatings(customers: np.ndarray, known: int, random) -> np.ndarray:
    """Tables of the words of a home in the parent; those of all ``known`` words are taken in proportion to these."""
    tables, number = np.minimum(customers, 1), int((customers > 0).sum())
    uniform = np.full(len(customers), 1 / (known + 1))
    for _ in range(BURN_IN):
        all_tables = tables.sum() * (known / max(1, number))
        tables = seat(customers, uniform, np.maximum(all_tables - tables, 0), DISCOUNT[0], STRENGTH[0], random)
    return tables


def predictive(customers, tables, all_customers, all_tables, base, level: int, discount: float | None = None):
    """The probability of the next customer's word."""
    d, s = DISCOUNT[level] if discount is None else discount, STRENGTH[level]
    return (customers - d * tables + (s + d * all_tables) * base) / (s + all_customers)


def runs_of(values: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and length of each run of equal values."""
    new = np.ones(len(values), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in (values, *more)])
    begins = np.flatnonzero(new)
    return begins, np.diff(np.append(begins, len(values)))


SAMPLED = ", ".join(f"tables{s} array<int>, spread_tables{s} array<bigint>" for s in range(SAMPLES))
STATE = (
    "part int, several_size array<int>, several_word array<int>, several_n array<int>, several_hash array<bigint>, "
    f"single array<int>, spread_place array<int>, spread_single array<bigint>, {SAMPLED}"
)
MERGED = (
    "buckets array<int>, steps array<array<int>>, size array<int>, word array<int>, n array<int>, hash array<bigint>, "
    f"least array<int>, spread_at array<int>, spread_no array<int>, tokens bigint, known bigint, spread_customers array<bigint>, {STATE}"
)
TOLD = "part int, home int, " + ", ".join(
    f"customers{s} array<int>, tables{s} array<int>, all_customers{s} bigint, all_tables{s} bigint" for s in range(SAMPLES)
)


def score(docs: DataFrame, is_training: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, n_tokens, n_known, train_tokens, base_score, score): a row per document."""
    spark = docs.sparkSession
    small_batches(spark)
    size, partitions = text_bytes(docs, text), shuffle_partitions(spark)
    buckets, parts, addresses = (max(partitions, -(-size // each)) for each in (BUCKET_BYTES, PART_BYTES, HOME_BYTES))
    dealt = docs.select(
        F.pmod(
            F.xxhash64(F.lit(17), F.col(doc_id), F.col(text), F.spark_partition_id()), F.lit(buckets)
        ).cast("int").alias("bucket"),
        is_training.alias("training"),
        F.struct("*").alias("row"),
    )
    with settings(spark, ONCE):
        frequent = frequent_words(docs.where(is_training).select(F.col(text).alias("text")))
    spread = np.unique(np.array([END, *(hash_joined(word)[0] for word in frequent)], np.uint64))
    discount = DISCOUNT[1] if CONTEXTS else 1.0
    state_types, merged_types = (
        [(field.name, to_arrow_type(field.dataType)) for field in T.StructType.fromDDL(ddl).fields] for ddl in (STATE, MERGED)
    )

    def in_few(frame: DataFrame, rows: int) -> DataFrame:
        """A file for 16 rows of what is kept between exchanges, a small share of the pairs."""
        return frame.coalesce(-(-rows // 16))

    def row_of(kinds: list[tuple[str, pa.DataType]], row: dict) -> pa.Table:
        return pa.table({name: pa.array([row[name]], kind) for name, kind in kinds})

    def dealt_to(number: int, hashes: np.ndarray) -> np.ndarray:
        return (hashes.view(np.uint64) % np.uint64(number)).astype(np.min_scalar_type(number))

    def in_order(tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """The part of each distinct pair, and the pairs in the order in which they are sent, by part, context and word."""
        part = dealt_to(parts, np.where(np.isin(tokens.contexts, spread), tokens.words, tokens.contexts))
        return part, np.argsort(part, kind="stable")

    def send_pairs(table: pa.Table) -> pa.Table:
        tokens = Tokens(binary_list(column_of(table, text)))
        part, order = in_order(tokens)
        counts = tokens.training_counts(table["training"].combine_chunks().to_numpy(zero_copy_only=False).astype(float))
        part, context = part[order], tokens.contexts[order].view(np.int64)
        begins, lengths = runs_of(context, part)
        used, sizes = np.unique(part, return_counts=True)
        contexts = np.unique(part[begins], return_counts=True)[1]
        return pa.table(
            {
                "part": pa.array(used, pa.int32()),
                "bucket": pa.array(np.full(len(used), table["bucket"][0].as_py()), pa.int32()),
                "context": lists(context[begins], contexts, pa.int64()),
                "size": lists(lengths, contexts, pa.int32()),
                "word": lists(tokens.words[order].view(np.int64), sizes, pa.int64()),
                "n": lists(counts[order], sizes, pa.int32()),
            }
        )

    def with_spread_tables(row: dict, sweeps: list[np.ndarray]) -> dict:
        """The state with these tables of its pairs, and all tables of this part in the spread restaurants."""
        for s in range(SAMPLES):
            row[f"tables{s}"], row[f"spread_tables{s}"] = np.empty(0, np.int32), np.empty(0, np.int64)
        for s, tables in enumerate(sweeps):
            number = np.repeat(row["spread_place"], row["several_size"]) + 1
            of_several = np.bincount(number, tables, minlength=len(spread) + 1).astype(np.int64)[1:]
            row[f"tables{s}"], row[f"spread_tables{s}"] = tables.astype(np.int32), row["spread_single"] + of_several
        return row

    def merge(table: pa.Table) -> pa.Table:
        """The distinct pairs of a part, by context; its words by home; those pairs and words that are seated."""
        (words, sizes), (n, _) = flat(table["word"]), flat(table["n"])
        words, contexts = words.view(np.uint64), np.repeat(flat(table["context"])[0].view(np.uint64), flat(table["size"])[0])
        order = np.lexsort((words, contexts))
        words, contexts = words[order], contexts[order]
        begins, lengths = runs_of(contexts, words)
        asked = np.empty(len(order), np.int32)
        asked[order] = np.repeat(np.arange(len(begins), dtype=np.int32), lengths)
        counts = np.bincount(asked, n, minlength=len(begins)).astype(np.int64)
        words, contexts = words[begins], contexts[begins]
        begins, lengths = runs_of(contexts)
        names, context = contexts[begins], np.repeat(np.arange(len(begins), dtype=np.int32), lengths)
        del order, contexts
        hashes, word = np.unique(words, return_inverse=True)
        order = np.argsort(dealt_to(addresses, hashes), kind="stable")
        place = np.empty(len(hashes), np.int32)
        place[order] = np.arange(len(hashes), dtype=np.int32)
        word, hashes = place[word], hashes[order]
        customers = np.add.reduceat(counts, begins)
        single = np.bincount(context, counts == 1, minlength=len(names)).astype(np.int64)
        spread_at = np.flatnonzero(np.isin(names, spread))
        spread_no = np.searchsorted(spread, names[spread_at])
        spread_customers, spread_single = np.zeros(len(spread), np.int64), np.zeros(len(spread), np.int64)
        spread_customers[spread_no], spread_single[spread_no] = customers[spread_at], single[spread_at]
        customers[spread_at] = 0
        # The pairs with several customers, with the contexts and words that have any.
        several = np.flatnonzero(counts > 1)
        begins, several_size = runs_of(context[several])
        of_several = context[several][begins]
        several_words, several_word = np.unique(word[several], return_inverse=True)
        places = np.full(len(names), -1)
        places[spread_at] = spread_no
        row = {
            "part": table["part"][0].as_py(),
            "buckets": table["bucket"].to_numpy(),
            # Pairs are asked for in the order of the part.
            "steps": [np.diff(asked[end - size : end], prepend=np.int32(0)) for end, size in zip(np.cumsum(sizes), sizes)],
            "size": lengths.astype(np.int32),
            "word": word,
            "n": counts.astype(np.int32),
            "hash": hashes.view(np.int64),
            "least": np.bincount(word, counts > 0, minlength=len(hashes)).astype(np.int32),
            "spread_at": spread_at.astype(np.int32),
            "spread_no": spread_no.astype(np.int32),
            "tokens": int(counts.sum()),
            "known": int((customers > 0).sum()),
            "spread_customers": spread_customers,
            "several_size": several_size.astype(np.int32),
            "several_word": several_word.astype(np.int32),
            "several_n": counts[several].astype(np.int32),
            "several_hash": hashes[several_words].view(np.int64),
            "single": single[of_several].astype(np.int32),
            "spread_place": places[of_several].astype(np.int32),
            "spread_single": spread_single,
        }
        return row_of(merged_types, with_spread_tables(row, [np.ones(len(several), np.int32)]))

    def by_home(hashes: np.ndarray, part: int, numbers: list[np.ndarray], asks: bool) -> pa.RecordBatch:
        """A message to every home, with those of the hashes that live there; numbers may be missing."""
        sizes = np.bincount(dealt_to(addresses, hashes), minlength=addresses)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(addresses), pa.int32()),
                pa.array(np.full(addresses, part), pa.int32()),
                pa.array(np.full(addresses, asks), pa.bool_()),
                lists(hashes, sizes, pa.int64()),
                *[lists(values, sizes * (len(values) > 0), pa.int32()) for values in numbers],
            ],
            names=["home", "part", "asks", "hash", *[f"n{s}" for s in range(len(numbers))]],
        )

    def message(samples: int) -> str:
        return "home int, part int, asks boolean, hash array<bigint>, " + ", ".join(f"n{s} array<int>" for s in range(samples))

    def send_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words of a part that have customers, with the contexts of each."""
        for batch in batches:
            for row in rows_of(batch):
                used = row["least"] > 0
                yield by_home(row["hash"][used], row["part"], [row["least"][used]], False)

    def settle(table: pa.Table) -> pa.Table:
        """The words of a home, with their contexts in all, the least number of their customers."""
        hashes, at = np.unique(flat(table["hash"])[0], return_inverse=True)
        least = np.bincount(at, flat(table["n0"])[0], minlength=len(hashes)).astype(np.int64)
        size = [len(hashes)]
        return pa.table({"home": table["home"][:1], "hash": lists(hashes, size, pa.int64()), "least": lists(least, size, pa.int64())})

    def send_customers(samples: int, asks: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """The customers of words beyond the least number, in each sample."""
            for batch in batches:
                for row in rows_of(batch):
                    more = [
                        np.bincount(row["several_word"], row[f"tables{s}"] - 1, minlength=len(row["several_hash"])).astype(np.int32)
                        for s in range(samples)
                    ]
                    yield by_home(row["several_hash"], row["part"], more, asks)

        return run

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All words of a part."""
        for batch in batches:
            for row in rows_of(batch):
                yield by_home(row["hash"], row["part"], [np.empty(0, np.int32)] * SAMPLES, True)

    def seat_parent(samples: int, known: int, seed: int):
        def run(settled: pa.Table, table: pa.Table) -> pa.Table:
            """Seats the customers of a home's words in the parent and answers the parts that ask."""
            names = flat(settled["hash"])[0]
            hashes, sizes = flat(table["hash"])
            at = np.searchsorted(names, hashes)
            # What is asked for may have no customers anywhere.
            has = at < len(names)
            has[has] = names[at[has]] == hashes[has]
            at = np.where(has, at, len(names))
            asks = table["asks"].combine_chunks().to_numpy(zero_copy_only=False)
            random = np.random.default_rng([11, seed, table["home"][0].as_py()])
            asking, told = at[np.repeat(asks, sizes)], at[np.repeat(flat(table["n0"])[1] > 0, sizes)]
            out = {"part": table["part"].filter(pa.array(asks)), "home": table["home"].filter(pa.array(asks))}
            for s in range(SAMPLES):
                if s >= samples:
                    nothing = lists(np.empty(0, np.int32), np.zeros(asks.sum(), np.int64), pa.int32())
                    out |= {f"customers{s}": nothing, f"tables{s}": nothing}
                    out |= {f"{name}{s}": pa.array(np.zeros(asks.sum()), pa.int64()) for name in ("all_customers", "all_tables")}
                    continue
                customers = np.bincount(told, flat(table[f"n{s}"])[0], minlength=len(names) + 1).astype(np.int64)
                customers[: len(names)] += flat(settled["least"])[0]
                tables = parent_seatings(customers, known, random)
                out[f"customers{s}"] = lists(customers[asking], sizes[asks], pa.int32())
                out[f"tables{s}"] = lists(tables[asking], sizes[asks], pa.int32())
                out[f"all_customers{s}"] = pa.array(np.full(asks.sum(), customers.sum()), pa.int64())
                out[f"all_tables{s}"] = pa.array(np.full(asks.sum(), tables.sum()), pa.int64())
            return pa.table(out)

        return run

    def seat_part(known: int, in_spread: np.ndarray, sweeps: int, seed: int):
        def run(table: pa.Table, told: pa.Table) -> pa.Table:
            row, told = next(rows_of(table.combine_chunks().to_batches()[0])), told.sort_by("home")
            context = np.repeat(np.arange(len(row["several_size"])), row["several_size"])
            is_spread, place = row["spread_place"] >= 0, row["spread_place"]
            # Tables of other parts, and of pairs with one customer.
            of_contexts = row["single"].astype(np.int64)
            of_contexts[is_spread] += (in_spread - row["spread_tables0"])[place[is_spread]]
            outside = Outside(
                flat(told["customers0"])[0].astype(np.int64), flat(told["tables0"])[0].astype(np.int64),
                told["all_customers0"].to_numpy().sum(), told["all_tables0"].to_numpy().sum(), known, of_contexts,
            )
            kept = seatings(
                row["several_word"], context, row["several_n"].astype(np.int64), parts, np.random.default_rng([7, seed, row["part"]]),
                outside, row["tables0"].astype(np.int64), sweeps, discount,
            )
            return row_of(state_types, with_spread_tables(row, [tables for tables, _, _ in kept]))

        return run

    def spread_totals(state: DataFrame, samples: int) -> np.ndarray:
        sums = [F.array(*[F.coalesce(F.sum(F.col(f"spread_tables{s}")[u]), F.lit(0)) for u in range(len(spread))]) for s in range(samples)]
        return np.array(state.agg(*sums).first(), np.int64)

    def answers(known: int, spread_customers: np.ndarray, in_spread: np.ndarray):
        def run(table: pa.Table, told: pa.Table) -> pa.Table:
            row, told = next(rows_of(table.combine_chunks().to_batches()[0])), told.sort_by("home")
            words, n = row["word"], row["n"]
            context, begins = np.repeat(np.arange(len(row["size"])), row["size"]), np.cumsum(row["size"]) - row["size"]

            def by_context(values: np.ndarray, of_spread: np.ndarray) -> np.ndarray:
                found = np.add.reduceat(values.astype(np.int64), begins)
                found[row["spread_at"]] = of_spread[row["spread_no"]]
                return found

            seen = by_context(n, spread_customers)
            chance = np.zeros(len(words))
            for s in range(SAMPLES):
                # First the seats of the part, then what each home says.
                parent = predictive(
                    flat(told[f"customers{s}"])[0], flat(told[f"tables{s}"][1:])[0],
                    told[f"all_customers{s}"].to_numpy()[1:].sum(), told[f"all_tables{s}"].to_numpy()[1:].sum(), 1 / (known + 1), 0,
                )
                tables = np.minimum(n, 1)
                tables[n > 1] = flat(told[f"tables{s}"][:1])[0]
                at_context = by_context(tables, in_spread[s])
                chance += predictive(n, tables, seen[context], at_context[context], parent[words], 1, discount)
            logs = np.log10(chance / SAMPLES)
            asked = [np.cumsum(steps) for steps in row["steps"]]
            contexts = [context[pairs] for pairs in asked]
            counts = [seen[found[runs_of(found)[0]]] for found in contexts]
            return pa.table(
                {
                    "bucket": pa.array(row["buckets"], pa.int32()),
                    "part": pa.array(np.full(len(asked), row["part"]), pa.int32()),
                    "log": lists(logs[np.concatenate(asked)], [len(x) for x in asked], pa.float32()),
                    "seen": lists(np.concatenate(counts), [len(x) for x in counts], pa.int64()),
                }
            )

        return run

    with settings(spark, ONCE):
        merged = keep(
            dealt.groupBy("bucket")
            .applyInArrow(
                send_pairs, "part int, bucket int, context array<bigint>, size array<int>, word array<bigint>, n array<int>"
            )
            .groupBy("part")
            .applyInArrow(merge, MERGED),
            "merged", compression="zstd",
        )
        totals = merged.agg(
            *[F.coalesce(F.sum(name), F.lit(0)) for name in ("tokens", "known")],
            F.array(*[F.coalesce(F.sum(F.col("spread_customers")[u]), F.lit(0)) for u in range(len(spread))]),
        ).first()
        train_tokens, spread_customers = totals[0], np.array(totals[2], np.int64)
        # Every word is a context as often as it occurs; the beginning, spread, stands for the end.
        known_words = totals[1] + int((spread_customers > 0).sum())
        settled = (
            merged.select("part", "hash", "least")
            .mapInArrow(send_words, message(1))
            .groupBy("home")
            .applyInArrow(settle, "home int, hash array<bigint>, least array<bigint>")
        )
        homes = keep(in_few(settled, addresses), "homes", compression="zstd")

        def told(messages: DataFrame, samples: int, seed: int) -> DataFrame:
            return homes.groupBy("home").cogroup(messages.groupBy("home")).applyInArrow(seat_parent(samples, known_words, seed), TOLD)

        state, before = merged.select(*[name for name, _ in state_types]), []
        for seed, sweeps in enumerate(ROUNDS):
            replies = told(state.mapInArrow(send_customers(1, True), message(1)), 1, seed)
            seated = (
                state.groupBy("part")
                .cogroup(replies.groupBy("part"))
                .applyInArrow(seat_part(known_words, spread_totals(state, 1)[0], sweeps, seed), STATE)
            )
            state = keep(in_few(seated, parts), "seated", compression="zstd")
            for frame in before:
                discard(frame)
            before = [state]
        messages = state.mapInArrow(send_customers(SAMPLES, False), message(SAMPLES)).unionAll(
            merged.select("part", "hash").mapInArrow(ask, message(SAMPLES))
        )
        none = {"customers": F.array().cast("array<int>"), "all_customers": F.lit(0).cast("long"), "all_tables": F.lit(0).cast("long")}
        seats = state.select(
            "part", F.lit(-1).alias("home"), *[f"tables{s}" for s in range(SAMPLES)],
            *[column.alias(f"{name}{s}") for name, column in none.items() for s in range(SAMPLES)],
        )
        replies = keep(
            merged.select("part", "buckets", "steps", "size", "word", "n", "spread_at", "spread_no")
            .groupBy("part")
            .cogroup(seats.unionByName(told(messages, SAMPLES, len(ROUNDS))).groupBy("part"))
            .applyInArrow(
                answers(known_words, spread_customers, spread_totals(state, SAMPLES)),
                "bucket int, part int, log array<float>, seen array<bigint>",
            ),
            "replies", compression="zstd",
        )
        for frame in (merged, homes, state):
            discard(frame)

    def assemble(table: pa.Table, replies: pa.Table) -> pa.Table:
        tokens = Tokens(binary_list(column_of(table, text)))
        part, order = in_order(tokens)
        replies = replies.sort_by("part")
        logs, seen = np.empty(len(order)), np.empty(len(order), np.int64)
        logs[order] = flat(replies["log"])[0]
        seen[order] = np.repeat(flat(replies["seen"])[0], runs_of(tokens.contexts[order], part[order])[1])
        # A token is the context of the next; the end occurs as often as the beginning.
        per_token = np.append(seen[tokens.pairs[1:]], 0)
        per_token[tokens.firsts + tokens.counts - 1] = seen[tokens.pairs[tokens.firsts]]
        base = np.log10((per_token + 1) / (train_tokens + known_words + 1))
        return pa.table(
            {
                "row": table["row"],
                "n_tokens": pa.array(tokens.counts, pa.int64()),
                "n_known": pa.array(np.add.reduceat((per_token > 0).astype(np.int64), tokens.firsts), pa.int64()),
                "train_tokens": pa.array(np.full(table.num_rows, train_tokens), pa.int64()),
                "base_score": pa.array(np.add.reduceat(base, tokens.firsts), pa.float64()),
                "score": pa.array(np.add.reduceat(logs[tokens.pairs], tokens.firsts), pa.float64()),
            }
        )

    return dealt.groupBy("bucket").cogroup(replies.groupBy("bucket")).applyInArrow(
        assemble,
        with_row(dealt, "n_tokens long, n_known long, train_tokens long, base_score double, score double"),
    )


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, lists of numbers as arrays."""
    for n in range(batch.num_rows):
        row = {}
        for name, column in zip(batch.schema.names, batch.columns):
            if not pa.types.is_list(column.type):
                row[name] = column[n].as_py()
            elif pa.types.is_list(column.type.value_type):
                row[name] = [x.values.to_numpy(zero_copy_only=False) for x in column.slice(n, 1).flatten()]
            else:
                row[name] = column.slice(n, 1).flatten().to_numpy(zero_copy_only=False)
        yield row
