"""Token ids of whole texts from the ids of their distinct words."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import numpy as np

from trailperks.llm.words import hash_joined

CACHED_WORDS = 1_000_000
#: A space or line end next to other white space: there the tokenizer's own pattern must decide where words end.
ODD_SPACES = re.compile(r"[ \n]\s|\s[ \n]|\n\Z")
#: Bytes that UTF-8 never holds: they mark a text's first word, which has no blank before it, and its end.
FIRST, END = b"\xff", b"\xfe"


class WordEncoder:
    """Token ids of whole texts, from the ids of their words.

    A byte-level tokenizer splits a text before each single blank or line end between two words, so the ids of a
    text are those of its words (with what stands before them) in a row. Words are known by a 64-bit hash (one to one up to seven bytes, else XXH64); each is
    given to ``encode_words`` once and its ids are remembered, in arrays ordered by hash. When more than ``CACHED_WORDS``
    are remembered, those that were used longest ago are forgotten. Texts with other white space, and those that hold one
    of the ``special`` texts, which the tokenizer looks for before it splits, go to ``encode_words`` whole. It returns the
    ids of all its texts in a row, and how many each has.
    """

    def __init__(
        self,
        encode_words: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
        end_ids: list[int],
        special: Sequence[str] = (),
    ):
        self.encode_words = encode_words
        self.whole = re.compile("|".join([ODD_SPACES.pattern, *map(re.escape, special)]))
        self.end = np.array(end_ids, dtype="<u4")
        self.ids, self.calls = self.end, 0
        self.hashes = hash_joined(END)
        self.offsets, self.lengths, self.used = (np.array([x], np.int32) for x in (0, len(end_ids), 0))

    def learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        texts = [
            (word[1:] if word[:1] == FIRST else word if word[:1] == b"\n" else b" " + word).decode() for word in words
        ]
        ids, lengths = self.encode_words(texts)
        offsets = np.cumsum(lengths) - lengths + len(self.ids)
        self.ids = np.concatenate([self.ids, ids.astype("<u4")])
        order = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, at, hashes[order])
        self.offsets = np.insert(self.offsets, at, offsets[order].astype(np.int32))
        self.lengths = np.insert(self.lengths, at, lengths[order].astype(np.int32))
        self.used = np.insert(self.used, at, self.calls)

    def gathered(self, known: np.ndarray) -> np.ndarray:
        """The ids of remembered words, one after the other."""
        lengths = self.lengths[known]
        begins = self.offsets[known] - (np.cumsum(lengths) - lengths)
        return self.ids[np.repeat(begins, lengths) + np.arange(lengths.sum())]

    def forget(self) -> None:
        self.used[np.searchsorted(self.hashes, hash_joined(END))] = self.calls
        kept = self.used > np.median(self.used)
        if not kept.any():
            return
        ids = self.gathered(np.flatnonzero(kept))
        self.hashes, self.lengths, self.used = self.hashes[kept], self.lengths[kept], self.used[kept]
        self.offsets, self.ids = (np.cumsum(self.lengths) - self.lengths).astype(np.int32), ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, with the end ids."""
        self.calls += 1
        if len(self.hashes) > CACHED_WORDS:
            self.forget()
        plain = [n for n, text in enumerate(texts) if not self.whole.search(text)]
        marked = [FIRST + texts[n].encode().replace(b"\n", b" \n") + b" " + END for n in plain]
        out: list[bytes] = [b""] * len(texts)
        if marked:
            joined = b" ".join(marked)
            hashes = hash_joined(joined)
            distinct, firsts, places = np.unique(hashes, return_index=True, return_inverse=True)
            at = np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)
            missing = self.hashes[at] != distinct
            self.used[at[~missing]] = self.calls
            if missing.any():
                self.learn(distinct[missing], words_at(joined, firsts[missing]))
                at = np.searchsorted(self.hashes, distinct)
            known = at[places]
            data = self.gathered(known).tobytes()
            counts = np.array([text.count(b" ") + 1 for text in marked])
            sizes = np.add.reduceat(self.lengths[known], np.cumsum(counts) - counts, dtype=np.int64) * 4
            for n, size, stop in zip(plain, sizes.tolist(), np.cumsum(sizes).tolist()):
                out[n] = data[stop - size : stop]
        for n in set(range(len(texts))).difference(plain):
            out[n] = np.concatenate([self.encode_words([texts[n]])[0].astype("<u4"), self.end]).tobytes()
        return out


def words_at(joined: bytes, numbers: np.ndarray) -> list[bytes]:
    """The words with these numbers, of words that single blanks separate."""
    ends = np.flatnonzero(np.frombuffer(joined + b" ", np.uint8) == 32)
    begins = np.where(numbers > 0, ends[numbers - 1] + 1, 0)
    return [joined[a:b] for a, b in zip(begins.tolist(), ends[numbers].tolist())]
