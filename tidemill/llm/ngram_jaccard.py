"""N-gram Jaccard join: documents whose sets of word n-grams are similar, as linked components.

Sets are collapsed to different ones first. Tokens (n-gram hashes) have one global order in which the
frequent class comes last, so two similar sets share a token in the prefixes of both. Sets with enough
rare tokens are indexed by those of the prefix, one by one. For the others the prefix is extended into
the frequent class, far enough that two similar sets also share neighbouring tokens there, and
combinations of two neighbours are the keys.

Keys of few sets give candidate pairs. A key of many sets never does: it is divided by size, and where
many sets of like size are left, they are compared with one of them, the pivot. All that two sets of
such a group have in common follows from what each has more or less than the pivot, and if both differ
from it in nothing they share, a link between them implies a link of both with the pivot. So only sets
whose differences overlap enough are candidates, which are found by prefixes of the differences. Every
candidate is verified exactly.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import Workspace, text_bytes
from tidemill.llm.components import connected

# A key of more sets than this is handled by a pivot.
FEW_SETS = 32
# Sets fetched by broadcasting their ids; more are fetched by a shuffled join.
BROADCAST_SETS = 200_000
STEP_BYTES = 1 << 20

_RANDOM = np.random.default_rng(20240501)
_BYTES = _RANDOM.integers(0, 1 << 64, 256, np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


# --- sets of n-grams -----------------------------------------------------------------------------


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def ngram_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """For each text the sorted different 64-bit hashes of its n-grams of words, A-Z in lower case.
    A text with fewer words has its whole sequence as the only one; without words it has none."""
    data, offsets = text_bytes(texts)
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    sizes = np.diff(offsets)
    before[offsets[:-1][sizes > 0]] = False
    after[offsets[1:][sizes > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    # The hash of a word is a difference of two running sums, moved to the same place.
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * _powers(_BASE, len(data)), out=sums[1:])
    words = _mixed((sums[ends] - sums[starts]) * _powers(_INVERSE, len(data) + 1)[starts])
    bounds = np.searchsorted(starts, offsets)
    grams = np.zeros(len(words), np.uint64)
    for k in range(min(n, len(words))):
        odd = np.uint64((2 * k + 3) * int(_BASE) % (1 << 64) | 1)
        grams[: len(words) - k] += words[k:] * odd
    grams = _mixed(grams).view(np.int64)  # as Spark orders them
    out = []
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if high - low >= n:
            out.append(np.unique(grams[low : high - n + 1]))
        elif high > low:
            short = hashlib.blake2b(words[low:high].tobytes(), digest_size=8).digest()
            out.append(np.frombuffer(short, np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def _sets_of(batches: Iterator[pa.RecordBatch], column: int, n: int):
    """Pieces of the batches, about STEP_BYTES of text each, with their sets."""
    for batch in batches:
        texts = batch.column(column)
        sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy())
        start = 0
        while start < len(texts):
            done = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, done + STEP_BYTES, "right")))
            yield batch.slice(start, stop - start), ngram_sets(texts.slice(start, stop - start), n)
            start = stop


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum(list(map(len, arrays)), out=ends[1:])
    values = np.concatenate([np.zeros(0, np.int64), *arrays])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def prefix_size(n: int, percent: int) -> int:
    """How many first tokens of a set of ``n`` must hold one of any similar set."""
    return n - (n * percent + 99) // 100 + 1


def signatures(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Of each document (_id, _hash, _text): set size, a digest of the set, and its first tokens, half
    as many again as its prefix and some more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets_of(batches, 2, n):
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            heads = [s[: prefix_size(len(s), percent) * 3 // 2 + 8] for s in sets]
            columns = {
                "_id": batch.column(0),
                "_hash": batch.column(1),
                "n": pa.array(list(map(len, sets)), pa.int64()),
                "digest": pa.array(digests, pa.binary()),
                "head": _lists(heads),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(run, "_id long, _hash long, n long, digest binary, head array<long>")


def checked(rows: DataFrame) -> DataFrame:
    """``rows``, narrow and written before, to be broadcast if there are at most BROADCAST_SETS."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_SETS else rows


def fetch_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """node, n and all tokens of the wanted nodes, from the text of one document of each."""
    keys = nodes.join(wanted, "node", "left_semi").select(
        "node", F.col("rep._id").alias("_key"), F.col("rep._hash").alias("_same")
    )
    if wanted.count() <= BROADCAST_SETS:
        keys = F.broadcast(keys)
    same = docs["_id"].eqNullSafe(keys["_key"]) & (docs["_hash"] == keys["_same"])
    texts = docs.join(keys, same).select("node", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets_of(batches, 1, n):
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(sets)], ["node", "tokens"])

    found = texts.mapInArrow(run, "node long, tokens array<long>")
    return found.groupBy("node").agg(F.first("tokens").alias("tokens"))  # one of repeated rows


# --- index ---------------------------------------------------------------------------------------


def prefix_column(n: Column, percent: int) -> Column:
    return n - F.ceil(n * percent / 100) + 1


def token_keys(
    nodes: DataFrame, percent: int, work: Workspace
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Keys of the sets that have enough rare tokens, the others, the frequent tokens, and the tokens
    that the heads of several sets have.

    Tokens in the heads of many sets are frequent. A set without any in its head has its prefix as
    keys; one with some takes later tokens instead, as long as the head has enough.
    """
    need = prefix_column(F.col("n"), percent).cast("int")
    tokens = nodes.select("node", F.explode("head").alias("key"))
    counts = tokens.groupBy("key").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    counts = work.keep(counts, "token-counts")
    frequent = work.keep(counts.where(F.col("sets") > FEW_SETS).select("key"), "frequent")
    gone = tokens.join(frequent, "key").groupBy("node").agg(F.collect_list("key").alias("gone"))
    rest = F.array_except("head", "gone")
    hit = nodes.join(gone, "node").select("node", "n", rest.alias("rare"))
    hit = work.keep(hit, "hit")
    scarce = F.size("rare") < F.least(need, F.col("n").cast("int"))
    whole = nodes.join(hit.select("node"), "node", "left_anti").select("node", "n", F.col("head").alias("rare"))
    keys = whole.unionByName(hit.where(~scarce)).select(
        "node", "n", F.explode(F.slice("rare", F.lit(1), need)).alias("key")
    )
    return keys, hit.where(scarce).select("node"), frequent, counts.select("key")


def dense_keys(sets: DataFrame, frequent: DataFrame, percent: int) -> DataFrame:
    """Keys of the sets with few rare tokens: those, and neighbours in the frequent class."""
    common = (
        sets.select("node", F.explode("tokens").alias("key"))
        .join(frequent, "key")
        .groupBy("node")
        .agg(F.array_sort(F.collect_list("key")).alias("common"))
    )
    n = F.col("n").cast("int")
    need = prefix_column(F.col("n"), percent).cast("int")
    rows = sets.join(common, "node", "left").select(
        "node",
        F.size("tokens").cast("long").alias("n"),
        F.coalesce("common", F.array().cast("array<bigint>")).alias("common"),
        F.when(F.col("common").isNull(), F.col("tokens"))
        .otherwise(F.array_except("tokens", "common"))
        .alias("rare"),
    )
    missing = need - 1 - F.size("rare")
    reach = 2 * missing + F.floor(n * (100 - percent) / percent).cast("int") + 2
    head = F.slice("common", F.lit(1), F.greatest(reach, F.lit(0)))
    pairs = F.zip_with(head, F.slice(head, F.lit(2), F.size(head)), lambda a, b: F.xxhash64(a, b, F.lit(2)))
    pairs = F.slice(pairs, F.lit(1), F.greatest(F.size(head) - 1, F.lit(0)))
    combined = F.when(missing >= 0, pairs).otherwise(F.array().cast("array<bigint>"))
    singles = F.slice("rare", F.lit(1), need)
    return rows.select("node", "n", F.explode(F.concat(singles, combined)).alias("key"))


# --- candidates ----------------------------------------------------------------------------------


def fits(n: Column, m: Column, percent: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def sized(keys: DataFrame, percent: int) -> DataFrame:
    """Two keys for each of ``keys``, of sets of like size: two that can link share one of them.

    Sizes fall into classes a little wider than the largest ratio of two that can link, so these are in
    one class or in neighbouring ones.
    """
    of = F.floor(F.log("n") / math.log(101 / percent))
    both = keys.select("key", "node", "n", F.explode(F.array(of, of + 1)).alias("sizes"))
    return both.select(F.xxhash64("key", "sizes").alias("key"), "node", "n")


def few_pairs(keys: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets that share a key of few sets; ``keys`` has these only."""
    left = keys.select("key", F.col("node").alias("a"), F.col("n").alias("na"))
    right = keys.select("key", F.col("node").alias("b"), F.col("n").alias("nb"))
    pairs = left.join(right, "key").where(
        (F.col("a") < F.col("b")) & fits(F.col("na"), F.col("nb"), percent)
    )
    return pairs.select("a", "b").distinct()


def plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose first tokens do not rule a link out.

    Of two sets that link, each lacks at most its size less the least overlap. So of the head that
    ends first, all tokens but these are in the other's head.
    """
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("head").alias("ha"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("head").alias("hb"))
    overlap = F.ceil((F.col("na") + F.col("nb")) * percent / (100 + percent))
    ends_first = F.element_at("ha", -1) <= F.element_at("hb", -1)
    least = F.when(ends_first, F.size("ha") - F.col("na")).otherwise(F.size("hb") - F.col("nb"))
    shared = F.size(F.array_intersect("ha", "hb"))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(shared >= least + overlap).select("a", "b")


def star_pairs(keys: DataFrame, weights: DataFrame, work: Workspace) -> DataFrame:
    """For each crowded key its pivot, the set with most copies, and the pivot's other sets."""
    rows = keys.join(weights, "node").select("key", "node", "copies")
    pivot = F.max(F.struct("copies", (-F.col("node")).alias("node"))).alias("best")
    pivots = rows.groupBy("key").agg(pivot).select("key", (-F.col("best.node")).alias("pivot"))
    pivots = work.keep(pivots, "pivots")  # written, so that the join can split a crowded key
    pairs = keys.join(pivots, "key").where("node <> pivot")
    return pairs.select("pivot", "node").distinct()


def linked(inter: Column, n: Column, m: Column, percent: int) -> Column:
    return inter * 100 >= (n + m - inter) * percent


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    inter = F.size(F.array_intersect("ta", "tb"))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(linked(inter, F.size("ta"), F.size("tb"), percent)).select("a", "b")


def differences(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of each set and pivot: what the set has more and what it lacks, and whether they link."""
    center = sets.select(F.col("node").alias("pivot"), F.col("tokens").alias("tp"))
    both = stars.join(sets.select("node", "tokens"), "node").join(center, "pivot")
    rows = both.select(
        "pivot",
        "node",
        F.size("tp").alias("np"),
        F.array_except("tokens", "tp").alias("more"),
        F.array_except("tp", "tokens").alias("less"),
    )
    inter = F.col("np") - F.size("less")
    size = inter + F.size("more")
    return rows.withColumn("linked", linked(inter, F.col("np"), size, percent))


def overlap_pairs(parts: DataFrame, percent: int, work: Workspace) -> DataFrame:
    """Links between sets of one pivot that do not both link with it, by their differences.

    With a = |less|, e = |more|, u = 100 a + percent e and slack = (100 - percent) np, two sets link if
    and only if their differences share (u + u' - slack) / (100 + percent) or more, and a set links
    with the pivot if u is at most slack. So a set that does not (a far one) shares more than
    u / (100 + percent) with another far one, and so does one that links with the pivot with a far
    one. Any two share at least (u - slack) / 100, as u' is percent or more for each shared token, and no
    more than either has. Tokens are ordered by how many of the pivot's sets
    have them, and those that one set alone has are in no prefix.

    What one of the differences has and the other does not is in one of the two sets only. A set of n
    has a link across (100 - percent) n / percent of these tokens at most, and two have one across
    (100 - percent) (n + n') / (100 + percent) at most, for both sides together. Up to the first token
    two differences share there are, on each side, those that one has alone and those before it. So
    in one of them that token comes within half of the set's own bound, and only this half is compared
    with the others' prefixes.
    """
    whole = 100 + percent
    size = F.size("less") + F.size("more")
    rows = parts.withColumn("u", 100 * F.size("less") + percent * F.size("more")).select(
        "pivot", "node", "linked", "u", size.alias("size"),
        (F.col("np") - F.size("less") + F.size("more")).alias("n"),
        ((100 - percent) * F.col("np")).alias("slack"),
        F.concat(
            F.transform("more", lambda t: F.xxhash64(t, F.lit(1))),
            F.transform("less", lambda t: F.xxhash64(t, F.lit(0))),
        ).alias("signed"),
    )
    # Without a far set there is nothing to find.
    some = work.keep(parts.where("NOT linked").select("pivot").distinct(), "far-pivots")
    rows = rows.join(some, "pivot", "left_semi")
    reach = rows.where("linked").groupBy("pivot").agg(
        F.max(whole * F.col("size") - F.col("u")).alias("reach")
    )
    tokens = rows.select("pivot", "node", F.explode("signed").alias("key"))
    counts = tokens.groupBy("pivot", "key").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    counts = work.keep(counts, "difference-counts")
    shared = tokens.join(counts, ["pivot", "key"]).groupBy("pivot", "node").agg(
        F.array_sort(F.collect_list(F.struct("sets", "key"))).alias("shared")
    )
    rows = rows.drop("signed").join(shared, ["pivot", "node"]).join(reach, "pivot", "left")
    alone = F.col("size") - F.size("shared")
    apart = F.floor((100 - percent) * F.col("n") / percent)

    def head(need: Column) -> Column:
        room = F.greatest(F.least(F.col("size") - need, apart) + 1 - alone, F.lit(0)).cast("int")
        return F.transform(F.slice("shared", F.lit(1), room), lambda t: t["key"])

    beyond = F.col("u") - F.col("slack")
    with_far, with_any = F.floor(F.col("u") / whole) + 1, F.ceil(beyond / 100)
    rows = rows.select(
        "pivot", "node", "linked", "u", "n", "size", "slack", alone.alias("alone"),
        head(F.greatest(with_far, with_any)).alias("own"),
        F.when(
            ~F.col("linked") & (beyond <= F.col("reach")), head(F.greatest(with_any, F.lit(1)))
        ).alias("far"),
    )
    rows = work.keep(rows, "difference-heads")

    def index(which: DataFrame, letter: str, heads: str) -> DataFrame:
        places = which.select("*", F.posexplode(heads).alias("place", "key"))
        return places.select(
            "pivot",
            "key",
            F.col("node").alias(letter),
            *(F.col(c).alias(f"{c}_{letter}") for c in ("u", "n", "size", "slack")),
            (F.col("alone") + F.col("place")).alias(f"apart_{letter}"),
        )

    def meeting(first: DataFrame, first_heads: str, second: DataFrame, second_heads: str) -> DataFrame:
        half = 2 * percent * F.col("apart_a") <= (100 - percent) * F.col("n_a")
        left = index(first, "a", first_heads).where(half)
        both = left.join(index(second, "b", second_heads), ["pivot", "key"])
        ordered = F.struct("apart_a", "a") < F.struct("apart_b", "b")
        least = F.col("u_a") + F.col("u_b") - F.col("slack_a")
        can_share = least <= whole * F.least("size_a", "size_b")
        total = (100 - percent) * (F.col("n_a") + F.col("n_b"))
        can_link = whole * (F.col("apart_a") + F.col("apart_b")) <= total
        like = fits(F.col("n_a"), F.col("n_b"), percent)
        return both.where(ordered & can_share & can_link & like)

    far, near = rows.where("NOT linked"), rows.where("linked")
    found = meeting(far, "own", far, "own")
    found = found.union(meeting(far, "far", near, "own")).union(meeting(near, "own", far, "far"))
    pairs = work.keep(found.select("pivot", "a", "b").distinct(), "overlaps")

    def side(letter: str) -> DataFrame:
        return parts.select(
            "pivot",
            F.col("node").alias(letter),
            F.col("more").alias(f"more_{letter}"),
            F.col("less").alias(f"less_{letter}"),
            *([F.col("np")] if letter == "a" else []),
        )

    both = pairs.join(side("a"), ["pivot", "a"]).join(side("b"), ["pivot", "b"])
    inter = (
        F.col("np")
        - F.size("less_a")
        - F.size("less_b")
        + F.size(F.array_intersect("less_a", "less_b"))
        + F.size(F.array_intersect("more_a", "more_b"))
    )
    n = F.col("np") - F.size("less_a") + F.size("more_a")
    m = F.col("np") - F.size("less_b") + F.size("more_b")
    return both.where(linked(inter, n, m, percent)).select("a", "b")


# --- the join ------------------------------------------------------------------------------------


def similar_components(
    docs: DataFrame,
    work: Workspace,
    id_column: str = "doc_id",
    text: str = "text",
    words: int = 3,
    percent: int = 90,
) -> DataFrame:
    """For each row of ``docs``: _id, _hash (of the text), n_shingles, component_id (the smallest id
    reachable by links), and first (whether id and text are those of the component's first document;
    true for a document without n-grams).

    Two documents link if 100 * intersection >= percent * union of their sets of n-grams of words;
    ``percent`` is 75 or more. Words are compared by 64-bit hashes.

    Defined cases: a null or empty text, or one without words, has no n-grams and links with nothing;
    one with fewer words than an n-gram has its whole sequence as the only one; equal and repeated
    rows link like any others, and each gives a row; a null id is larger than any other and only is
    the component's if no other is there; an empty table gives an empty result; other columns are
    ignored, whatever their names.
    """
    if percent < 75:
        raise ValueError("combinations of neighbours need a similarity of 75 percent or more")
    docs = docs.select(
        F.col(id_column).cast("long").alias("_id"),
        F.xxhash64(text).alias("_hash"),
        F.col(text).alias("_text"),
    )
    signed = work.keep(signatures(docs, words, percent), "signatures")
    members = work.keep(signed.select("_id", "_hash", "n", "digest"), "members")
    groups = signed.where("n > 0").groupBy("digest").agg(
        F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_hash")).alias("rep"),
        F.count(F.lit(1)).alias("copies"),
        F.first("n").alias("n"),
        F.first("head").alias("head"),
    )
    nodes = groups.withColumn("node", F.monotonically_increasing_id())
    nodes = work.keep(nodes, "nodes")
    work.forget("signatures")
    work.tidy()
    # A set this small has no similar one but itself.
    alone = -(-percent // (100 - percent))
    large = nodes.where(F.col("n") >= alone)
    links = work.keep(links_between(docs, large, work, words, percent), "links")
    labels = connected(nodes.select("node", F.col("rep").alias("label")), links, work)
    found = nodes.select("node", "digest").join(labels, "node").select("digest", "label")
    own = members.select("_id", "_hash", "digest", F.col("n").alias("n_shingles"))
    joined = own.join(found, "digest", "left")
    empty = F.col("n_shingles") == 0
    leads = F.col("_id").eqNullSafe(F.col("label._id")) & (F.col("_hash") == F.col("label._hash"))
    return joined.select(
        "_id",
        "_hash",
        "n_shingles",
        F.when(empty, F.col("_id")).otherwise(F.col("label._id")).alias("component_id"),
        (empty | leads).alias("first"),
    )


def links_between(
    docs: DataFrame, nodes: DataFrame, work: Workspace, words: int, percent: int
) -> DataFrame:
    """Links (a, b) that connect all that is connected; between sets that link with one pivot there
    are only the links with it."""
    keys, dense, frequent, several = token_keys(nodes, percent, work)
    dense = work.keep(dense, "dense")
    dense_sets = work.keep(fetch_sets(docs, nodes, dense, words), "dense-sets")
    more_keys = work.keep(dense_keys(dense_sets, frequent, percent), "dense-keys")
    # A token of one head alone is a key of two sets only if a dense one has it, too.
    known = several.union(more_keys.select("key"))
    keys = work.keep(keys.join(known, "key", "left_semi").unionByName(more_keys), "keys")
    for name in ("token-counts", "hit", "dense-keys"):
        work.forget(name)
    counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    shared = work.keep(keys.join(work.keep(counts, "counts"), "key"), "shared")
    work.forget("keys")
    work.forget("counts")
    few, many = F.col("sets") <= FEW_SETS, F.col("sets") > FEW_SETS
    crowds = work.keep(sized(shared.where(many), percent), "crowds")
    counts = crowds.groupBy("key").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    crowds = crowds.join(work.keep(counts, "counts"), "key")
    pairs = few_pairs(shared.union(crowds.select(*shared.columns)).where(few).drop("sets"), percent)
    pairs = work.keep(plausible(pairs, nodes, percent), "pairs")
    weights = nodes.select("node", "copies")
    stars = work.keep(star_pairs(crowds.where(many).drop("sets"), weights, work), "stars")
    for name in ("shared", "crowds", "counts", "pivots"):
        work.forget(name)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).union(
        stars.select(F.explode(F.array("pivot", "node")))
    )
    wanted = wanted.distinct().join(dense, "node", "left_anti")
    wanted = work.keep(wanted, "wanted")
    sets = dense_sets.unionByName(fetch_sets(docs, nodes, wanted, words))
    sets = work.keep(sets, "sets")
    work.tidy()
    parts = work.keep(differences(stars, sets, percent), "differences")
    near = parts.where("linked").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    across = overlap_pairs(parts, percent, work)
    return verified(pairs, sets, percent).union(near).union(across).distinct()
