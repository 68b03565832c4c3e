"""Suffix arrays of many short texts at once, by grouping suffixes with equal Lyndon prefixes.

The construction is linear and not recursive. A group holds suffixes that begin alike, in their order a group is a range of
the suffix array. First, groups are processed from the largest to the smallest: the previous smaller pointer of a suffix goes to the
nearest suffix on its left in a smaller group. Suffixes to which several (or one) pointers of the processed group go are
moved out of their groups, those of most pointers into the last new group behind the old one. When all groups are processed, a
group holds the suffixes with one Lyndon prefix. Then the order is emitted: the suffix before each emitted one, and along its
pointers all that are not yet emitted, take the next free place of their groups.

All texts take a step at the same time, each in its own ranges, so numpy works on one group of every text, or emits one suffix
of each. The number of steps is that of the longest text, the work of a step that of the texts still at work.
"""

from __future__ import annotations

import numpy as np


def ranges(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of several ranges, one range after the other."""
    shift = begins - (np.cumsum(lengths) - lengths)
    return np.arange(int(lengths.sum()), dtype=begins.dtype) + np.repeat(shift, lengths).astype(begins.dtype)


def heads(*columns: np.ndarray) -> np.ndarray:
    """Rows of sorted columns at which one of them changes."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


class Grouping:
    """The groups of suffixes of several texts; a group is named by its first place in the suffix array."""

    def __init__(self, symbols: np.ndarray, ends: np.ndarray):
        size = len(symbols)
        self.size, self.ends = size, ends.astype(np.int32)
        self.begins = np.concatenate([[0], ends[:-1]]).astype(np.int32)
        texts = np.repeat(np.arange(len(ends), dtype=np.int64), self.ends - self.begins)
        keys = (texts << 16) | symbols
        self.order = np.argsort(keys, kind="stable").astype(np.int32)
        self.rank = np.empty(size, np.int32)
        self.rank[self.order] = np.arange(size, dtype=np.int32)
        first = heads(keys[self.order]).astype(np.int32)
        lengths = np.diff(np.append(first, size))
        # One more suffix, smaller than all, stands for "none".
        self.group = np.full(size + 1, -1, np.int32)
        self.group[self.order] = np.repeat(first, lengths)
        self.group_end = np.empty(size, np.int32)
        self.group_end[first] = first + lengths
        self.smaller = np.arange(-1, size, dtype=np.int32)
        self.smaller[self.begins] = size
        self.touched = np.zeros(size, bool)

    def previous_smaller(self, members: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """Set the pointers of the suffixes of the processed groups."""
        pointers = self.smaller[members]
        todo = np.flatnonzero(self.group[pointers] >= groups)
        while len(todo):
            # Whatever lies between a suffix and the end of its pointer is not smaller, so pointers may be followed.
            pointers[todo] = self.smaller[pointers[todo]]
            self.smaller[members[todo]] = pointers[todo]
            todo = todo[self.group[pointers[todo]] >= groups[todo]]
        return pointers

    def split(self, suffixes: np.ndarray, counts: np.ndarray) -> None:
        """Move suffixes to new groups behind the rest of their old ones, by ascending numbers of pointers."""
        groups = self.group[suffixes]
        by = np.lexsort((counts, groups))
        suffixes, counts, groups = suffixes[by], counts[by], groups[by]
        old = heads(groups)
        moving = np.diff(np.append(old, len(groups)))
        names = groups[old]
        tails = self.group_end[names] - moving.astype(np.int32)
        places = ranges(tails, moving)
        ranks = self.rank[suffixes]
        # Those that stay leave the end of the range for the places that become free.
        self.touched[ranks] = True
        leaving = places[~self.touched[places]]
        free = np.sort(ranks[ranks < np.repeat(tails, moving)])
        self.touched[ranks] = False
        staying = self.order[leaving]
        self.order[free], self.rank[staying] = staying, free
        self.order[places], self.rank[suffixes] = suffixes, places
        new = heads(groups, counts)
        lengths = np.diff(np.append(new, len(groups)))
        first = places[new]
        self.group[suffixes] = np.repeat(first, lengths)
        self.group_end[first] = first + lengths.astype(np.int32)
        rest = tails > names
        self.group_end[names[rest]] = tails[rest]

    def process(self) -> None:
        """Process the groups of all texts from the largest to the smallest."""
        texts, tops = np.arange(len(self.ends)), self.ends.copy()
        while len(texts):
            ends = tops[texts]
            groups = self.group[self.order[ends - 1]]
            sizes = ends - groups
            members = self.order[ranges(groups, sizes)]
            pointers = self.previous_smaller(members, np.repeat(groups, sizes))
            suffixes, counts = np.unique(pointers[pointers < self.size], return_counts=True)
            if len(suffixes):
                self.split(suffixes, counts)
            tops[texts] = groups
            texts = texts[groups > self.begins[texts]]

    def emit(self) -> np.ndarray:
        """The suffixes of each text in their order."""
        out = np.full(self.size, -1, np.int32)
        out[self.begins] = self.ends - 1
        free = np.arange(self.size, dtype=np.int32)
        emitted = np.zeros(self.size + 1, bool)
        emitted[self.size] = emitted[self.ends - 1] = True
        at, begins, ends = self.begins.copy(), self.begins, self.ends

        def before(places: np.ndarray, begins: np.ndarray) -> np.ndarray:
            suffixes = out[places]
            return np.where(suffixes == begins, self.size, suffixes - 1)

        suffixes = before(at, begins)
        while len(at):
            fresh = np.flatnonzero(~emitted[suffixes])
            own = suffixes[fresh]
            groups = self.group[own]
            places = free[groups]
            out[places] = own
            free[groups] = places + 1
            emitted[own] = True
            suffixes[fresh] = self.smaller[own]
            over = np.flatnonzero(emitted[suffixes])
            at[over] += 1
            if (done := at == ends).any():
                at, begins, ends, suffixes = (column[~done] for column in (at, begins, ends, suffixes))
                over = np.flatnonzero(emitted[suffixes])
            suffixes[over] = before(at[over], begins[over])
        return out


def suffix_arrays(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffixes, as places in ``symbols``, in their order inside each text.

    Texts follow each other and end before ``ends``; the last symbol of each is smaller than all its others.
    """
    grouping = Grouping(symbols, ends)
    grouping.process()
    return grouping.emit()
