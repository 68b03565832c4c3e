"""Runs of repeated words, found with string synchronising sets.

A run is a stretch of consecutive words of a text with smallest period q (words q apart are equal) and at least
``max(least, 3 q)`` words that neither neighbouring word extends. Texts are read where they lie, without a shuffle; the words of
``BATCH`` bytes of texts are numbers in one array, on which numpy does all steps for all these texts at once:

* **Small periods** (below ``SMALL``) are detected directly: stretches in which words p apart are equal.
* **Periods from 3 t to 6 t**, for t = 4, 8, 16, …, come from a synchronising set. Every place has a hash of the t words
  from it on; place i is chosen if the smallest hash of the places i .. i + t stands at either end. Whether i is chosen
  depends on the 2 t words from it on alone, and every t consecutive places hold a chosen one, unless the text around is highly
  periodic (period at most t / 3). Such places are left out of the choice; where they are is known from the smaller periods.
  In a run of period q there is a place whose text is not highly periodic (else q were not the smallest period), thus a chosen
  place i such that the run also holds i + q, chosen for the same context of 2 t words. So pairs of chosen places with equal
  contexts and a distance from 3 t to 6 t propose all periods. Only pairs at such distances are formed, a bounded number
  for each place, however often a context occurs.
* A proposed period is extended to both sides by comparing hashes of word sequences, stretches found more than once are
  merged, and each is compared word by word; where a hash was wrong, the stretch is measured by words.

Of stretches with the same begin and end the smallest period counts: at a length of three periods, a smaller period divides
the larger one and has the same stretch.

A word is dropped if a run contains it after the run's first q words, so one period of each run is left.

Defined results: a null text has no words. Words are separated by ASCII white space and compared by their bytes. A text without
a run keeps all words. Repeated rows and ids are judged each for itself. Other columns pass through in the struct ``row``. An
empty table gives an empty result. Memory is bounded by ``BATCH`` bytes of text, or one longer text, and some 100 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from trailperks.llm.common import binary_list, field_of, slices, small_batches, with_row

#: Bytes of text that are worked on at a time.
BATCH = 2**21
#: Periods below are looked for directly; the synchronising sets begin with windows of SMALL / 3 words.
SMALL = 12
WORD_BASE = 0x9E3779B97F4A7C15
LAST = np.uint64(2**64 - 1)

RESULT = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


class Texts:
    """The words of several texts as numbers, one text after the other; equal words have equal numbers."""

    def __init__(self, words: list[list[bytes]]):
        numbers: dict[bytes, int] = {}
        number = numbers.setdefault
        flat = [number(word, len(numbers)) for text in words for word in text]
        self.words = np.array(flat, np.int64)
        counts = np.array([len(text) for text in words], np.int64)
        self.ends = np.cumsum(counts)
        self.begins = self.ends - counts
        self.text = np.repeat(np.arange(len(words)), counts)
        self.until = np.repeat(self.ends, counts)  # the end of each word's text
        size = len(self.words)
        table = np.array([xxhash.xxh64_intdigest(word) for word in numbers] or [0], np.uint64)
        up, down = (np.cumprod(np.full(size + 1, factor, np.uint64)) for factor in (WORD_BASE, pow(WORD_BASE, -1, 2**64)))
        self.down = down
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(table[self.words] * up[:-1])])

    def hashes(self, begins: np.ndarray, length) -> np.ndarray:
        """Hash of ``length`` words from each place on."""
        return mixed((self.sums[begins + length] - self.sums[begins]) * self.down[begins])

    def equal(self, one: np.ndarray, other: np.ndarray, length: np.ndarray) -> np.ndarray:
        return self.hashes(one, length) == self.hashes(other, length)

    def common_after(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How many words from ``one`` on equal those from ``other`` (behind it) on, by hashes."""
        most = self.until[np.minimum(one, len(self.words) - 1)] - other
        return self.longest(most, lambda length, pick: self.equal(one[pick], other[pick], length))

    def common_before(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How many words before ``one`` equal those before ``other`` (behind it), by hashes."""
        most = one - self.begins[self.text[one]]
        return self.longest(most, lambda length, pick: self.equal(one[pick] - length, other[pick] - length, length))

    @staticmethod
    def longest(most: np.ndarray, holds) -> np.ndarray:
        """The largest length up to ``most`` for which ``holds``: doubling steps, then halving ones."""
        found = np.zeros(len(most), np.int64)
        step, pick = 1, np.flatnonzero(most > 0)
        steps = []
        while len(pick):
            pick = pick[found[pick] + step <= most[pick]]
            pick = pick[holds(found[pick] + step, pick)]
            found[pick] += step
            steps.append(step)
            step *= 2
        for step in reversed(steps):
            pick = np.flatnonzero(found + step <= most)
            pick = pick[holds(found[pick] + step, pick)]
            found[pick] += step
        return found


def stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def small_periods(texts: Texts) -> np.ndarray:
    """(begin, end, period) of all stretches of at least three periods, for periods below ``SMALL``."""
    out = [np.empty((0, 3), np.int64)]
    for period in range(1, SMALL):
        if len(texts.words) <= period:
            break
        same = (texts.words[:-period] == texts.words[period:]) & (texts.text[:-period] == texts.text[period:])
        begins, ends = stretches(same)
        keep = ends - begins >= 2 * period
        out.append(np.stack([begins[keep], ends[keep] + period, np.full(keep.sum(), period)], axis=1))
    return smallest(np.concatenate(out))


def smallest(runs: np.ndarray) -> np.ndarray:
    """The smallest period of each (begin, end)."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[new]


def highly_periodic(size: int, runs: np.ndarray, window: int) -> np.ndarray:
    """Places from which on ``window`` words have a period of at most a third of that."""
    inside = runs[(runs[:, 2] <= window // 3) & (runs[:, 1] - runs[:, 0] >= window)]
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, inside[:, 0], 1)
    np.add.at(change, inside[:, 1] - window + 1, -1)
    return np.cumsum(change)[:size] > 0


def least_of(values: np.ndarray, count: int) -> np.ndarray:
    """The least of ``count`` values from each place on; places near the end see fewer."""
    out, width = values.copy(), 1
    while width < count:
        step = min(width, count - width)
        out[:-step] = np.minimum(out[:-step], out[step:])
        width += step
    return out


def synchronising_set(texts: Texts, window: int, runs: np.ndarray) -> np.ndarray:
    """Chosen places, for windows of so many words, in texts that can hold a run of such a period."""
    long = texts.ends - texts.begins >= 9 * window
    places = np.flatnonzero(long[texts.text])
    left = texts.until[places] - places
    values = np.full(len(places), LAST)
    fits = left >= window
    values[fits] = texts.hashes(places[fits], window) >> np.uint64(1)  # below LAST
    values[highly_periodic(len(texts.words), runs, window)[places]] = LAST
    least = least_of(values, window + 1)
    inside = np.flatnonzero(left >= 2 * window)
    ends = np.minimum(values[inside], values[inside + window])
    return places[inside[(ends != LAST) & (ends == least[inside])]]


def proposals(texts: Texts, window: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of chosen places with equal contexts, at distances from 3 to 6 windows in one text."""
    contexts = texts.hashes(chosen, 2 * window)
    order = np.lexsort((chosen, contexts, texts.text[chosen]))
    places, contexts, text = chosen[order], contexts[order], texts.text[chosen[order]]
    at, periods, pick = [], [], np.arange(len(places))
    behind = 1
    while len(pick):
        pick = pick[pick + behind < len(places)]
        other = pick + behind
        distance = places[other] - places[pick]
        near = (contexts[other] == contexts[pick]) & (text[other] == text[pick]) & (distance < 6 * window)
        pick, distance = pick[near], distance[near]
        wide = distance >= 3 * window
        at.append(places[pick[wide]])
        periods.append(distance[wide])
        behind += 1
    return np.concatenate([np.empty(0, np.int64), *at]), np.concatenate([np.empty(0, np.int64), *periods])


def measured(texts: Texts, begin: int, end: int, period: int) -> list[tuple[int, int, int]]:
    """The stretches of a period by words alone, inside the text around a stretch that hashes found."""
    text = texts.text[begin]
    low, high = int(texts.begins[text]), int(texts.ends[text])
    begins, ends = stretches(texts.words[low : high - period] == texts.words[low + period : high])
    found = [(low + b, low + e + period, period) for b, e in zip(begins.tolist(), ends.tolist())]
    return [(b, e, p) for b, e, p in found if e - b >= 3 * p and b < end and e > begin]


def verified(texts: Texts, found: np.ndarray) -> np.ndarray:
    """Stretches whose words really repeat and that nothing extends; others are measured again."""
    out = []
    for begin, end, period in found.tolist():
        text = texts.text[begin]
        before = begin == texts.begins[text] or texts.words[begin - 1] != texts.words[begin - 1 + period]
        after = end == texts.ends[text] or texts.words[end] != texts.words[end - period]
        if before and after and np.array_equal(texts.words[begin : end - period], texts.words[begin + period : end]):
            out.append((begin, end, period))
        else:
            out += measured(texts, begin, end, period)
    return np.array(out, np.int64).reshape(-1, 3)


def runs_of(texts: Texts, least: int) -> np.ndarray:
    """(begin, end, period) of all runs, places counted over all texts."""
    runs = small_periods(texts)
    longest = int((texts.ends - texts.begins).max(initial=0))
    window = SMALL // 3
    while 9 * window <= longest:
        at, periods = proposals(texts, window, synchronising_set(texts, window, runs))
        if len(at):
            # Places of one run propose it again and again; neighbours that agree are measured once.
            order = np.lexsort((at, periods))
            at, periods = at[order], periods[order]
            begins = at - texts.common_before(at, at + periods)
            new = np.ones(len(at), bool)
            new[1:] = (begins[1:] != begins[:-1]) | (periods[1:] != periods[:-1])
            begins, periods = begins[new], periods[new]
            ends = begins + periods + texts.common_after(begins, begins + periods)
            wide = ends - begins >= 3 * periods
            found = verified(texts, np.stack([begins[wide], ends[wide], periods[wide]], axis=1))
            runs = smallest(np.concatenate([runs, found]))
        window *= 2
    return runs[runs[:, 1] - runs[:, 0] >= np.maximum(least, 3 * runs[:, 2])]


def judged(values: list[bytes], least: int) -> dict[str, pa.Array]:
    """The columns of the result for these texts."""
    words = [text.split() for text in values]
    texts = Texts(words)
    found = runs_of(texts, least)
    owners = texts.text[found[:, 0]] if len(found) else np.empty(0, np.int64)
    change = np.zeros(len(texts.words) + 1, np.int32)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 1], -1)
    kept = np.cumsum(change)[:-1] == 0
    runs: list[list[dict[str, int]]] = [[] for _ in values]
    for owner, (begin, end, period) in zip(owners.tolist(), found.tolist()):
        runs[owner].append({"start": begin - int(texts.begins[owner]), "length": end - begin, "period": period})
    collapsed = []
    for number, own in enumerate(words):
        mask = kept[texts.begins[number] : texts.ends[number]]
        collapsed.append(b" ".join(compress(own, mask) if runs[number] else own))
    for own in runs:
        own.sort(key=lambda run: (run["start"], run["period"]))
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
    return {
        "n_words": pa.array([len(own) for own in words], pa.int64()),
        "runs": pa.array(runs, kind),
        "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string()),
    }


def find_runs(docs: DataFrame, least: int = 24, text: str = "text") -> DataFrame:
    """(row, n_words, runs, collapsed): a row per document; runs by start, then period."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("row"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = field_of(batch["row"], text)
            for begin, end in slices(column, BATCH):
                found = judged(binary_list(column.slice(begin, end - begin)), least)
                yield pa.RecordBatch.from_pydict({"row": batch["row"].slice(begin, end - begin)} | found)

    return rows.mapInArrow(judge, with_row(rows, RESULT))


def strongest(runs: Column) -> Column:
    """The run with the greatest exact ratio of length and period; of equals the first one."""
    more = lambda one, other: one["length"] * other["period"] > other["length"] * one["period"]
    first = F.get(runs, F.lit(0))
    return F.aggregate(runs, first, lambda best, run: F.when(more(run, best), run).otherwise(best))
