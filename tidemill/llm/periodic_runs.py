"""Runs of words that repeat with a period, found by descending-LCP Kruskal.

Texts are taken a piece at a time inside tasks; nothing is shuffled. A piece's suffixes are sorted by
prefix doubling in numpy, where only suffixes that still tie are sorted again, and the ranks of each
doubling give the longest common prefix of neighbours in the order. Neighbours are then united by
decreasing common prefix: each class of suffixes is an ordered set of word positions, and when two
classes become one at a common prefix of ``l`` words, a position of one and the next position of the
other, ``p`` words further, have exactly ``l`` words in common. With ``p <= l`` the text has period
``p`` from the first of them to ``l`` words behind the second. ``p`` is the smallest period there: with
a smaller one, another position of the class would lie between the two.

All seeds of a run name the same period and end; the leftmost one is where the run begins. A run of
``length >= max(min_length, min_exponent * period)`` has a seed with a common prefix of at least
``shortest_prefix`` words at its begin, so lesser neighbours are left out, which in prose are nearly
all. That loses no run.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.llm.words import Words, byte_class, pieces

# Words are what stands between ASCII white space.
SPACES = b" \t\n\v\f\r"
# Bytes of text that are in memory as arrays at once, as far as whole texts allow.
PIECE_BYTES = 4 * 1024**2
# Up to this many positions are put into a larger set one by one; more are merged by sorting.
FEW = 8

FOUND = (
    "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
)
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def shortest_prefix(min_length: int, min_exponent: int) -> int:
    """The least common prefix at the begin of a run that is long enough, whatever its period."""
    periods = range(1, min_length + 1)
    return min(max(min_length - p, (min_exponent - 1) * p) for p in periods)


def _groups(keys: np.ndarray) -> np.ndarray:
    """For each place of a sorted array the first place of its value."""
    first = np.arange(len(keys))
    first[1:][keys[1:] == keys[:-1]] = 0
    return np.maximum.accumulate(first)


def _tied(first: np.ndarray) -> np.ndarray:
    """Whether other places share this place's first place."""
    same = first[1:] == first[:-1]
    tied = np.zeros(len(first), bool)
    tied[1:] |= same
    tied[:-1] |= same
    return tied


def suffix_ranks(codes: np.ndarray, row: np.ndarray, stop: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words, each suffix ending with its row.

    A rank is the number of smaller ones, so that it stays right when only ties are sorted again. The
    last array has no ties.
    """
    n = len(codes)
    keys = row * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(keys)
    first = _groups(keys[order])
    rank = np.empty(n, np.int32)
    rank[order] = first
    levels, step = [rank], 1
    open_ = order[_tied(first)]
    while len(open_):
        ahead = open_ + step
        inside = ahead < stop[open_]
        next_rank = np.where(inside, rank[np.minimum(ahead, n - 1)], -1).astype(np.int64)
        keys = rank[open_] * np.int64(n + 1) + next_rank + 1
        order = np.argsort(keys)
        open_, keys = open_[order], keys[order]
        first = _groups(keys)
        rank = rank.copy()
        rank[open_] += (first - _groups(rank[open_])).astype(np.int32)
        levels.append(rank)
        open_ = open_[_tied(first)]
        step *= 2
    return levels


def neighbours(
    levels: list[np.ndarray], stop: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order with a common prefix of at least ``least`` words, and its length."""
    n, depth = len(stop), least.bit_length() - 1
    if len(levels) <= depth + 1:  # all differ within the first 2 ** depth words
        none = np.zeros(0, np.int64)
        return none, none, none
    suffixes = np.empty(n, np.int64)
    suffixes[levels[-1]] = np.arange(n)
    left, right = suffixes[:-1], suffixes[1:]
    alike = levels[depth][left] == levels[depth][right]
    left, right = left[alike], right[alike]
    common = np.zeros(len(left), np.int64)
    for k in range(len(levels) - 2, -1, -1):
        x, y = left + common, right + common
        inside = (x < stop[left]) & (y < stop[right])
        x, y = np.minimum(x, n - 1), np.minimum(y, n - 1)
        common[inside & (levels[k][x] == levels[k][y])] += 1 << k
    enough = common >= least
    return left[enough], right[enough], common[enough]


def kruskal_seeds(
    left: np.ndarray, right: np.ndarray, common: np.ndarray, min_length: int, min_exponent: int
) -> np.ndarray:
    """Rows (first position, period, common prefix) of positions that become neighbours in a class,
    where these make a run that is long enough."""
    places, ends = np.unique(np.concatenate([left, right]), return_inverse=True)
    order = np.argsort(-common, kind="stable")
    lefts, rights = ends[: len(left)][order].tolist(), ends[len(left) :][order].tolist()
    parent, members = list(range(len(places))), [[p] for p in places.tolist()]
    seeds: list[tuple[int, int, int]] = []
    more = min_exponent - 1

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x, y, shared in zip(lefts, rights, common[order].tolist()):
        x, y = root(x), root(y)
        if len(members[x]) < len(members[y]):
            x, y = y, x
        large, small = members[x], members[y]
        parent[y], members[y] = x, []
        spots = [bisect_left(large, s) for s in small]
        size, last = len(large), len(small) - 1
        for j, (s, k) in enumerate(zip(small, spots)):
            if k and (j == 0 or spots[j - 1] < k):  # the position before is of the other class
                p = s - large[k - 1]
                if more * p <= shared and p + shared >= min_length:
                    seeds.append((s - p, p, shared))
            if k < size and (j == last or spots[j + 1] > k):  # so is the one after
                p = large[k] - s
                if more * p <= shared and p + shared >= min_length:
                    seeds.append((s, p, shared))
        if len(small) <= FEW:
            for j, (s, k) in enumerate(zip(small, spots)):
                large.insert(k + j, s)
        else:
            large += small
            large.sort()
    return np.array(seeds, np.int64).reshape(-1, 3)


def runs_of(
    codes: np.ndarray, first: np.ndarray, min_length: int, min_exponent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and smallest period of all runs, by begin and period; positions count words of all
    rows, of which row ``r`` has those from ``first[r]`` on."""
    sizes = np.diff(first)
    row, stop = np.repeat(np.arange(len(sizes)), sizes), np.repeat(first[1:], sizes)
    least = shortest_prefix(min_length, min_exponent)
    pairs = neighbours(suffix_ranks(codes, row, stop), stop, least)
    seeds = kruskal_seeds(*pairs, min_length, min_exponent)
    begin, period = seeds[:, 0], seeds[:, 1]
    end = begin + period + seeds[:, 2]
    order = np.lexsort((begin, period, end))
    begin, period, end = begin[order], period[order], end[order]
    new = np.ones(len(begin), bool)
    new[1:] = (end[1:] != end[:-1]) | (period[1:] != period[:-1])
    begin, period, end = begin[new], period[new], end[new]
    order = np.lexsort((period, begin))
    return begin[order], end[order], period[order]


def collapse(words: Words, begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> pa.Array:
    """Each row's words joined by one space, without those that a run holds after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, begin + period, 1)
    np.add.at(change, end, -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    edges = np.searchsorted(kept, words.first)
    followed = np.ones(len(kept), bool)
    followed[edges[1:][np.diff(edges) > 0] - 1] = False
    stops, data = words.end[kept], words.data.copy()
    data[stops[followed]] = ord(" ")  # white space stands there, as another word follows
    inside = np.zeros(len(data) + 1, np.int8)
    inside[words.begin[kept]] = 1
    inside[stops + followed] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
    sizes = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=sizes[1:])
    offsets = sizes[words.offsets].astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1, buffers)


def found_in(texts: pa.Array, min_length: int, min_exponent: int) -> list[pa.Array]:
    words = Words(texts, byte_class(SPACES))
    begin, end, period = runs_of(words.coded()[0], words.first, min_length, min_exponent)
    row = np.searchsorted(words.first, begin, "right") - 1
    parts = [begin - words.first[row], end - begin, period]
    runs = pa.StructArray.from_arrays(list(map(pa.array, parts)), fields=list(RUN))
    ends = np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32)
    listed = pa.ListArray.from_arrays(pa.array(ends), runs)
    return [pa.array(np.diff(words.first)), listed, collapse(words, begin, end, period)]


def periodic_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_length: int = 24,
    min_exponent: int = 3,
) -> DataFrame:
    """All maximal runs of words with a period, and each text without the repetitions.

    Returns a row for each row of ``docs``: the id, n_words, runs (start as a word number from 0,
    length in words, smallest period; by start, then period) and collapsed, the words joined by one
    space without those that any run holds after its first period. A run is a stretch of words in
    which words ``period`` apart are the same, of at least ``min_length`` words and ``min_exponent``
    periods, that no word next to it extends.

    Defined cases: a null, empty or blank text has no words, no runs and an empty collapsed text.
    Repeated rows and ids give a row each. Overlapping runs are all returned. A text of any length is
    taken whole, in memory of about 150 bytes a word of the longest one. Words are compared as bytes.
    Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    out = StructType().add(docs.select(F.col(id_column)).schema[0])
    for field in StructType.fromDDL(FOUND):
        out.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for start, stop in pieces(texts, PIECE_BYTES):
                size = stop - start
                columns = found_in(texts.slice(start, size), min_length, min_exponent)
                ids = batch.column(0).slice(start, size)
                yield pa.RecordBatch.from_arrays([ids, *columns], names=out.names)

    chosen = docs.select(F.col(id_column), F.col(text).cast("string"))
    return chosen.mapInArrow(run, out)
