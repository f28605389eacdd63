"""Periodic runs of words: Lyndon roots from a suffix sorter's first phase, extended to runs.

A run is a longest stretch of words that repeats with a smallest period. Every run holds, under one of
the two orders of its words, a Lyndon word of just its period that is the longest one from where it
starts. The first phase of Baier's suffix sorter groups suffixes by just these longest Lyndon words, so
one pass in each order lists all roots, and common extensions to both sides of a root and its repeat
give the run. Any order of the words will do; here it is that of their codes in a chunk of texts.

A text is one row and its words are one task's work; tasks take texts a chunk at a time. Before words
are sorted, those go that no run can hold. A run of ``n`` words and period ``q`` has ``n - q >= n / 2``
words that are equal to those ``q`` on, so each of its words lies in a window of half the least length
that occurs twice in the run. Words outside such windows cut a text into stretches that are searched each
for itself, and the test is made again within each stretch. Windows are compared by hash, and a chance
agreement only lets more words through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from standings.llm.common import WORD_BREAK, tidy, whole

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])


@dataclass(frozen=True)
class RunRules:
    """Runs of ``min_length`` words or more, and of two periods or more; ``chunk_chars`` bounds a task's memory."""

    min_length: int = 12
    chunk_chars: int = 2_000_000


def lyndon_lengths(ranks: list[int]) -> list[int]:
    """For each place, the length of the longest Lyndon word that starts there.

    Groups of places begin as places with the same letter, and are handled from the highest down. A
    place of the group at hand ends the Lyndon word of the nearest place before it in a lower group:
    that word grows by the group's own, once for each place that names it, and the place moves to a
    new group just above its old one, those with more repeats higher.
    """
    letters = {r: g for g, r in enumerate(sorted(set(ranks)))}
    group = [letters[r] for r in ranks]
    members: list[list[int]] = [[] for _ in letters]
    for place, g in enumerate(group):
        members[g].append(place)
    count = len(letters)
    length, below, above = [1] * count, list(range(-1, count - 1)), [*range(1, count), -1]
    before, done = [-1] * len(ranks), bytearray(len(ranks))

    def move(places: list[int], old: int, grown: int) -> None:
        new, higher = len(length), above[old]
        length.append(grown)
        below.append(old)
        above.append(higher)
        if higher >= 0:
            below[higher] = new
        above[old] = new
        members.append(places)
        for place in places:
            group[place] = new

    g = count - 1
    while g >= 0:
        own = [place for place in members[g] if group[place] == g]
        members[g] = []
        own.sort()
        for place in own:
            done[place] = 1
        named: dict[int, int] = {}
        for place in own:
            j = place - 1
            while j >= 0 and done[j]:
                j = before[j]
            before[place] = j
            if j >= 0:
                named[j] = named.get(j, 0) + 1
        alike: dict[tuple[int, int], list[int]] = {}
        for j, times in named.items():
            alike.setdefault((times, group[j]), []).append(j)
        for times, old in sorted(alike, reverse=True):
            move(alike[times, old], old, length[old] + times * length[g])
        g = below[g]
    return [length[g] for g in group]


def repeated_windows(codes: np.ndarray, stretch: np.ndarray, width: int) -> np.ndarray:
    """Which places lie in a window of ``width`` words that occurs twice or more in its stretch."""
    n = len(codes) - width + 1
    if n < 1:
        return np.zeros(len(codes), bool)
    hashes = stretch[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = codes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    for k in range(width):
        hashes *= np.uint64(0xFF51AFD7ED558CCD)
        hashes += mixed[k : k + n]
        hashes ^= hashes >> np.uint64(29)
    at = np.flatnonzero(stretch[:n] == stretch[width - 1 :])
    order = at[np.argsort(hashes[at])]
    same = hashes[order[1:]] == hashes[order[:-1]]
    depth = np.zeros(len(codes) + 1, np.int32)
    begins = np.zeros(n, bool)
    begins[order[1:][same]] = begins[order[:-1][same]] = True
    depth[:n] += begins
    depth[width : width + n] -= begins
    return np.cumsum(depth[:-1]) > 0


def stretches(codes: np.ndarray, document: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that a run may hold, and the stretch of each: neighbours in one document, ``min_length`` or more."""
    places, stretch = np.arange(len(codes)), document
    while len(places):
        held = repeated_windows(codes[places], stretch, -(-min_length // 2))
        places, old = places[held], stretch[held]
        breaks = (np.diff(places, prepend=-2) != 1) | (np.diff(old, prepend=-1) != 0)
        number = np.cumsum(breaks) - 1
        long = np.bincount(number, minlength=1)[number] >= min_length if len(places) else held[:0]
        places, stretch = places[long], number[long]
        if 10 * len(places) > 9 * len(held):
            break
    return places, stretch


class Extensions:
    """How far two places agree, to the right and to the left, by names of blocks of 2^k words."""

    def __init__(self, codes: np.ndarray, longest: int):
        self.names = [codes.astype(np.int64)]
        while 1 << len(self.names) <= longest:
            half, last = 1 << (len(self.names) - 1), self.names[-1]
            if len(last) <= half:
                break
            pairs = last[:-half] * (int(last.max()) + 1) + last[half:]
            self.names.append(np.unique(pairs, return_inverse=True)[1].reshape(-1))

    def _walk(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        far = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.names))):
            names, size = self.names[k], 1 << k
            # A block of each level at most is added, save at the top, where blocks may follow each other.
            live = np.arange(len(a))
            while len(live):
                x = a[live] + step * far[live] - (size - 1 if step < 0 else 0)
                y = b[live] + step * far[live] - (size - 1 if step < 0 else 0)
                inside = (np.minimum(x, y) >= 0) & (np.maximum(x, y) < len(names))
                live, x, y = live[inside], x[inside], y[inside]
                live = live[names[x] == names[y]]
                far[live] += size
                if k + 1 < len(self.names):
                    break
        return far

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self._walk(a, b, 1)

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self._walk(a, b, -1)


def find_runs(codes: np.ndarray, document: np.ndarray, min_length: int) -> np.ndarray:
    """Rows (first place, length, period) of all runs in texts that follow each other, by place and period.

    ``codes`` are the words' codes, not negative, and ``document`` the number of each word's text.
    """
    places, stretch = stretches(codes, document, min_length)
    if not len(places):
        return np.zeros((0, 3), np.int64)
    begins = np.flatnonzero(np.diff(stretch, prepend=-1))
    ends = np.append(begins[1:], len(places))
    # A separator of its own after each stretch, so that no agreement reaches beyond.
    number = np.repeat(np.arange(len(begins)), ends - begins)
    parted = np.full(len(places) + len(begins), 0, np.int64)
    at = np.arange(len(places)) + number
    parted[at] = codes[places] + len(begins)
    parted[ends + np.arange(len(begins))] = np.arange(len(begins))
    extensions = Extensions(parted, int((ends - begins).max()))
    found = []
    for sign in (1, -1):
        periods = np.empty(len(places), np.int64)
        for begin, end in zip(begins.tolist(), ends.tolist()):
            periods[begin:end] = lyndon_lengths((sign * codes[places[begin:end]]).tolist())
        root = np.flatnonzero(np.arange(len(places)) + periods < ends[number])
        again = at[root] + periods[root]
        equal = parted[at[root]] == parted[again]
        root, again = root[equal], again[equal]
        left = extensions.left(at[root] - 1, again - 1)
        size = left + periods[root] + extensions.right(at[root], again)
        enough = size >= np.maximum(min_length, 2 * periods[root])
        found.append(np.stack([places[root] - left, periods[root], size], 1)[enough])
    runs = np.concatenate(found)
    return (np.unique(runs, axis=0) if len(runs) else runs)[:, [0, 2, 1]]


def word_runs(docs: DataFrame, rules: RunRules = RunRules(), text: str = "text") -> DataFrame:
    r"""One row per row of ``docs``: ``_row``, ``n_words``, ``runs``, ``collapsed``.

    ``runs`` lists (start, length, period) of every run of words ``[^\x20\x09-\x0D]+`` by start, then
    period. ``collapsed`` is the text's words joined by one space, without the words that any run holds after
    its first period. ``_row`` holds the other columns. A null or empty text has no words, no runs and an
    empty collapsed text; repeated rows are treated alike; an empty table gives an empty result. Texts
    are searched whole, whatever their length, in time that grows with the number of words.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    rows = docs.select(F.struct(*others).alias("_row"), whole(F.col(f"`{text}`")).alias("text"))
    fields = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())]
    schema = T.StructType([rows.schema["_row"], *fields])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pc.utf8_length(batch.column("text")).to_numpy())
            begins = np.flatnonzero(np.diff(sizes // rules.chunk_chars, prepend=-1)).tolist()
            for begin, end in zip(begins, [*begins[1:], len(batch)]):
                yield _chunk(batch.slice(begin, end - begin), rules)

    return rows.mapInArrow(lambda batches: tidy(task(batches)), schema)


def _chunk(batch: pa.RecordBatch, rules: RunRules) -> pa.RecordBatch:
    parts = pc.split_pattern_regex(batch.column("text"), WORD_BREAK)
    words, owner = pc.list_flatten(parts), np.repeat(np.arange(len(batch)), np.diff(np.asarray(parts.offsets)))
    filled = pc.not_equal(words, "")
    words, owner = words.filter(filled), owner[np.asarray(filled)]
    codes = np.asarray(words.dictionary_encode().indices).astype(np.int64)
    first = np.searchsorted(owner, np.arange(len(batch) + 1))
    runs = find_runs(codes, owner, rules.min_length)
    dropped = np.zeros(len(codes) + 1, np.int32)
    np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
    np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(dropped[:-1]) == 0)
    offsets = np.searchsorted(kept, first).astype(np.int32)
    collapsed = pc.binary_join(pa.ListArray.from_arrays(offsets, words.take(pa.array(kept))), " ")
    of = owner[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
    values = pa.StructArray.from_arrays(
        [pa.array(runs[:, 0] - first[of]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], ["start", "length", "period"]
    )
    lists = pa.ListArray.from_arrays(np.searchsorted(of, np.arange(len(batch) + 1)).astype(np.int32), values)
    return pa.RecordBatch.from_arrays(
        [batch.column("_row"), pa.array(np.diff(first)), lists, collapsed],
        ["_row", "n_words", "runs", "collapsed"],
    )
