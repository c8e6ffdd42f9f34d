"""Exact phrase and proximity search in a distributed positional inverted index.

The documents are the index: a task cuts its rows into segments of bounded size and writes, for each
term of a segment, the ascending list of its positions there. Positions number a segment's words, with
a gap between documents, so a phrase never crosses two of them. Lists are segment by segment, so a term
that every document holds has no long list anywhere, and building needs no shuffle.

The searched items are cut into blocks of bounded size. For each block, the lists of its terms are
grouped by segment. A segment starts every phrase from the list of its rarest term there, moves the
positions back by the term's place in the phrase, and intersects them with the lists of the other terms,
rarer ones first, each moved back alike. Equal moved positions are an exact phrase. With a ``slop``,
moved positions that lie within so many words of each other are a proximity match.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.llm.common import Workspace
from tidemill.llm.words import Words, byte_class, lower_ascii, pieces

# Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased.
SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
# Text in one segment, as far as whole texts allow.
SEGMENT_BYTES = 8 * 1024**2
# Text of items in one block: it goes to the driver and from there to all executors.
BLOCK_BYTES = 4 * 1024**2
# Starts of phrases that are looked up at once.
CHUNK = 1_000_000
# Keys are a term's code and a position; the room keeps neighbouring terms' positions apart.
SPAN, ROOM = 1 << 38, 1 << 20

LISTS = "segment long, term string, n int, places binary, doc_ids array<long>, starts array<long>"
FOUND = "segment long, row int, doc_id long, item int, first long, last long, exact boolean"


# --- lists of positions ------------------------------------------------------------------------


def pack(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each number in as many bytes as it needs, seven bits a byte, and how many bytes that is."""
    sizes = np.ones(len(numbers), np.int64)
    for bits in (7, 14, 21, 28):
        sizes += numbers >= 1 << bits
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    for j in range(5):
        some = np.flatnonzero(sizes > j)
        if not len(some):
            break
        more = (sizes[some] > j + 1).astype(np.uint8) << 7
        out[starts[some] + j] = ((numbers[some] >> (7 * j)) & 127).astype(np.uint8) | more
    return out, sizes


def unpack(data: np.ndarray) -> np.ndarray:
    stops = np.flatnonzero(data < 128) + 1
    starts = np.concatenate([np.zeros(1, np.int64), stops[:-1]])[: len(stops)]
    sizes = stops - starts
    out = np.zeros(len(stops), np.int64)
    for j in range(int(sizes.max(initial=0))):
        some = np.flatnonzero(sizes > j)
        out[some] |= (data[starts[some] + j].astype(np.int64) & 127) << (7 * j)
    return out


def _segment(number: int, doc_ids: pa.Array, texts: pa.Array) -> Iterator[pa.RecordBatch]:
    words = Words(texts, byte_class(SEPARATORS), lower_ascii())
    codes, dictionary = words.coded()
    rows = np.arange(len(texts) + 1)
    starts = words.first + rows  # a free position after each row
    places = np.arange(len(words)) + np.repeat(rows[:-1], np.diff(words.first))
    order = np.argsort(codes, kind="stable")
    codes, places = codes[order], places[order]
    sizes = np.bincount(codes, minlength=len(dictionary))
    steps = np.diff(places, prepend=0)
    heads = np.cumsum(sizes) - sizes
    steps[heads] = places[heads]
    packed, widths = pack(steps)
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(widths)])
    offsets = ends[np.append(heads, len(codes))].astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(packed)]
    lists = pa.Array.from_buffers(pa.binary(), len(dictionary), buffers)
    whole = pa.array([starts.tolist()], pa.list_(pa.int64()))
    ids = pa.ListArray.from_arrays([0, len(doc_ids)], doc_ids)
    yield pa.RecordBatch.from_pydict(
        {
            "segment": pa.array([number], pa.int64()),
            "term": pa.nulls(1, pa.string()),
            "n": pa.array([len(words)], pa.int32()),
            "places": pa.nulls(1, pa.binary()),
            "doc_ids": ids,
            "starts": whole,
        }
    )
    terms = len(dictionary)
    yield pa.RecordBatch.from_pydict(
        {
            "segment": pa.array(np.full(terms, number), pa.int64()),
            "term": dictionary.cast(pa.string()),
            "n": pa.array(sizes, pa.int32()),
            "places": lists,
            "doc_ids": pa.nulls(terms, ids.type),
            "starts": pa.nulls(terms, whole.type),
        }
    )


def build_index(
    docs: DataFrame, work: Workspace, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The positional index of all words of all rows, as a written table.

    A row is a term's list in a segment; the row without a term names the segment's documents and
    where each begins. Null and empty texts have no words; rows that share an id, or have none, stay
    documents of their own. Other columns are ignored, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(1)
            for start, stop in pieces(texts, SEGMENT_BYTES):
                ids = batch.column(0).slice(start, stop - start)
                yield from _segment(number, ids, texts.slice(start, stop - start))
                number += 1

    chosen = docs.select(F.col(id_column).cast("long"), F.col(text).cast("string"))
    return work.keep(chosen.mapInArrow(run, LISTS), "lists")


def directory(index: DataFrame) -> DataFrame:
    """The indexed documents: segment, row (place in it), doc_id, n_words, of each."""
    size = F.col("starts")[F.col("row") + 1] - F.col("starts")[F.col("row")] - 1
    each = index.where("term IS NULL").select(
        "segment", "starts", F.posexplode("doc_ids").alias("row", "doc_id")
    )
    return each.select("segment", "row", "doc_id", size.alias("n_words"))


# --- items -------------------------------------------------------------------------------------


@dataclass
class Phrases:
    """The different windows of a block of items.

    ``terms`` are codes of ``vocabulary``, padded with -1; window ``w`` is in the items
    ``holders[bounds[w]:bounds[w + 1]]``, each named once.
    """

    vocabulary: pa.Array
    terms: np.ndarray
    sizes: np.ndarray
    holders: np.ndarray
    bounds: np.ndarray


def phrases(texts: pa.Array, numbers: np.ndarray, window: int) -> Phrases:
    """All stretches of ``window`` words of the texts; shorter texts are one whole, empty ones none."""
    words = Words(texts, byte_class(SEPARATORS), lower_ascii())
    codes, dictionary = words.coded()
    n = np.diff(words.first)
    sizes = np.minimum(n, window)
    count = np.where(n > 0, n - sizes + 1, 0)
    row = np.repeat(np.arange(len(n)), count)
    start = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + words.first[row]
    inside = np.arange(window) < sizes[row][:, None]
    spots = np.minimum(start[:, None] + np.arange(window), max(0, len(codes) - 1))
    terms = np.where(inside, codes[spots] if len(codes) else -1, -1).astype(np.int32)
    terms, own = np.unique(terms, axis=0, return_inverse=True)
    pairs = np.unique(np.stack([own.reshape(-1), numbers[row]], 1), axis=0)
    bounds = np.searchsorted(pairs[:, 0], np.arange(len(terms) + 1))
    vocabulary = dictionary.cast(pa.string())
    return Phrases(vocabulary, terms, (terms >= 0).sum(1), pairs[:, 1], bounds)


# --- search ------------------------------------------------------------------------------------


def _keys(lists: pa.Table, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code and position of all listed words in one ascending array, and each code's first place."""
    codes = pc.index_in(lists["term"].combine_chunks(), vocabulary)
    lists = lists.append_column("code", pa.chunked_array([codes])).sort_by("code")
    codes, sizes = lists["code"].to_numpy(), lists["n"].to_numpy().astype(np.int64)
    steps = unpack(np.frombuffer(b"".join(lists["places"].to_pylist()), np.uint8))
    sums = np.cumsum(steps)
    heads = np.cumsum(sizes) - sizes
    before = sums[heads] - steps[heads]
    places = sums - np.repeat(before, sizes)
    keys = np.repeat(codes.astype(np.int64), sizes) * SPAN + places + ROOM
    return keys, np.searchsorted(keys, np.arange(len(vocabulary) + 1) * SPAN)


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - sizes), sizes)


def search_segment(
    lists: pa.Table, wanted: Phrases, slop: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Matches in one segment: window, first and last position, and whether it is exact."""
    keys, heads = _keys(lists, wanted.vocabulary)
    counts = np.diff(heads)
    inside = wanted.terms >= 0
    rarity = np.where(inside, counts[wanted.terms], np.iinfo(np.int64).max)
    order = np.argsort(rarity, axis=1, kind="stable")
    seeds = rarity.min(axis=1, initial=np.iinfo(np.int64).max)
    live = np.flatnonzero((seeds > 0) & (wanted.sizes > 0))
    out = []
    total = np.cumsum(seeds[live])
    for part in np.split(live, np.flatnonzero(np.diff(total // CHUNK)) + 1):
        lead = order[part, 0]
        term = wanted.terms[part, lead]
        sizes = counts[term]
        for low in range(0, int(sizes.max(initial=0)), CHUNK):  # a list longer than a chunk
            some = np.clip(sizes - low, 0, CHUNK)
            window = np.repeat(part, some * (slop + 1))
            moved = keys[_ranges(heads[term] + low, some)] % SPAN - np.repeat(lead, some)
            moved = (moved[:, None] - np.arange(slop + 1)).ravel()
            first, last = np.full(len(moved), SPAN), np.zeros(len(moved), np.int64)
            least, most = np.full(len(moved), slop), np.zeros(len(moved), np.int64)
            for step in range(wanted.terms.shape[1]):
                more = wanted.sizes[window] > step
                place = order[window, step]
                sought = wanted.terms[window, place].astype(np.int64) * SPAN + moved + place
                spot = np.searchsorted(keys, sought)
                away = keys[np.minimum(spot, len(keys) - 1)] - sought
                keep = ~more | ((away >= 0) & (away <= slop))
                position = moved + place + away
                first = np.where(more, np.minimum(first, position), first)[keep]
                last = np.where(more, np.maximum(last, position), last)[keep]
                least = np.where(more, np.minimum(least, away), least)[keep]
                most = np.where(more, np.maximum(most, away), most)[keep]
                window, moved = window[keep], moved[keep]
                if not len(window):
                    break
            tight = least == 0  # others start from a smaller position than any term has
            spots = (window, first - ROOM, last - ROOM, most == 0)
            out.append(tuple(x[tight] for x in spots))
    return tuple(map(np.concatenate, zip(*out))) if out else (np.zeros(0, np.int64),) * 4


def _merged(
    item: np.ndarray, first: np.ndarray, last: np.ndarray, exact: np.ndarray, row: np.ndarray
) -> list[np.ndarray]:
    """Overlapping or touching matches of an item in a row as one stretch; exact ones for themselves."""
    order = np.lexsort((first, exact, item, row))
    item, first, last, exact, row = (x[order] for x in (item, first, last, exact, row))
    same = np.zeros(len(item), bool)
    same[1:] = (item[1:] == item[:-1]) & (exact[1:] == exact[:-1]) & (row[1:] == row[:-1])
    lift = np.cumsum(~same) * (int(last.max(initial=0)) + 2)
    reach = np.maximum.accumulate(last + lift) - lift
    new = ~same
    new[1:] |= first[1:] > reach[:-1] + 1
    begins = np.flatnonzero(new)
    ends = np.append(begins, len(item))[1:] - 1
    return [item[begins], first[begins], reach[ends], exact[begins], row[begins]]


def searcher(wanted: Phrases, slop: int) -> Callable[[pa.Table], pa.Table]:
    def search(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        known = pc.is_null(rows["term"])
        head = rows.filter(known).select(["segment", "doc_ids", "starts"]).to_pylist()[0]
        window, first, last, exact = search_segment(rows.filter(pc.invert(known)), wanted, slop)
        starts = np.array(head["starts"], np.int64)
        row = np.searchsorted(starts, first, "right") - 1
        # A phrase is of consecutive words, but words near each other may be in two documents.
        within = last < starts[row + 1] - 1
        window, first, last, exact, row = (x[within] for x in (window, first, last, exact, row))
        many = np.diff(wanted.bounds)[window]
        item = wanted.holders[_ranges(wanted.bounds[window], many)]
        spread = (np.repeat(x, many) for x in (first, last, exact, row))
        item, first, last, exact, row = _merged(item, *spread)
        ids = pa.array(head["doc_ids"], pa.int64())
        return pa.table(
            {
                "segment": pa.array(np.full(len(row), head["segment"]), pa.int64()),
                "row": pa.array(row, pa.int32()),
                "doc_id": ids.take(pa.array(row, pa.int64())),
                "item": pa.array(item, pa.int32()),
                "first": pa.array(first - starts[row], pa.int64()),
                "last": pa.array(last - starts[row], pa.int64()),
                "exact": pa.array(exact, pa.bool_()),
            }
        )

    return search


def find_passages(
    index: DataFrame,
    items: DataFrame,
    work: Workspace,
    id_column: str = "item_id",
    text: str = "text",
    window: int = 10,
    slop: int = 0,
) -> DataFrame:
    """Where windows of the items occur in the indexed documents.

    Returns segment, row, doc_id, item_id, first and last (word numbers in the document, from 0) and
    exact. Windows of an item that touch or overlap in a document are one row, exact and proximity
    matches apart. With ``slop`` 0 there are exact matches only. Otherwise a window also matches
    where all its terms stand so that their positions, each less the term's place in the window, are
    at most ``slop`` apart; of several positions of a term the first one counts, and a word may stand
    for a term that the window repeats.

    Defined cases: null and empty items have no windows, an item shorter than ``window`` is one
    window; an item without an id is found like any other, with a null item_id; equal items are all
    named. Documents without words match nothing. Either table may be empty.
    """
    spark = index.sparkSession
    chosen = items.select(F.col(id_column).alias("item_id"), F.col(text).cast("string").alias("text"))
    chosen = work.keep(chosen.where(F.length("text") > 0), "items")
    size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks)))
    parts = []
    for block in range(blocks):
        rows = chosen.where(place == block).collect()  # about BLOCK_BYTES of text
        texts = pa.array([r["text"] for r in rows], pa.string())
        wanted = phrases(texts, np.arange(len(rows)), window)
        terms = spark.createDataFrame([(t,) for t in wanted.vocabulary.to_pylist()], "term string")
        # The terms of one block of items, so broadcasting them is bounded.
        needed = index.where("term IS NOT NULL").join(F.broadcast(terms), "term", "left_semi")
        needed = needed.select(index.columns).union(index.where("term IS NULL"))
        found = needed.groupBy("segment").applyInArrow(_task(spark, wanted, slop), FOUND)
        names = spark.createDataFrame(
            [(n, r["item_id"]) for n, r in enumerate(rows)],
            chosen.select(F.lit(0).alias("item"), "item_id").schema,
        )
        # As many names as the block has items.
        parts.append(work.keep(found.join(F.broadcast(names), "item").drop("item"), "found"))
    columns = ["segment", "row", "doc_id", "item_id", "first", "last", "exact"]
    none = StructType.fromDDL(FOUND.replace("item int", "item_id string"))
    none["item_id"].dataType = chosen.schema["item_id"].dataType
    out = spark.createDataFrame([], none)
    for part in parts:
        out = out.union(part.select(columns))
    return out


def _task(spark, wanted: Phrases, slop: int) -> Callable[[pa.Table], pa.Table]:
    """The search of a block, whose phrases each executor gets once."""
    shared = spark.sparkContext.broadcast(wanted)

    def search(rows: pa.Table) -> pa.Table:
        return searcher(shared.value, slop)(rows)

    return search


def covered(index: DataFrame, found: DataFrame) -> DataFrame:
    """For every indexed document doc_id, n_words, n_hit (words inside any match) and items (the
    sorted ids, as strings, of the items that match)."""
    document = ["segment", "row"]
    before = (
        Window.partitionBy(*document)
        .orderBy("first", "last")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reach = F.coalesce(F.max("last").over(before), F.lit(-1))
    fresh = F.greatest(F.lit(0), F.col("last") - F.greatest(F.col("first") - 1, reach))
    hits = (
        found.withColumn("fresh", fresh)
        .groupBy(*document)
        .agg(
            F.sum("fresh").alias("n_hit"),
            F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
        )
    )
    return directory(index).join(hits, document, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
