"""Line dedup: later copies of repeated line runs are deleted, the first copy stays.

Documents are sequences of line ids. A suffix array of all of them is built by distributed prefix
doubling: two suffixes have the same rank at level j if their first 2^j lines are equal, and ranks
keep the order of these prefixes. The next level sorts by the pair of a suffix's rank and the rank of
the suffix 2^j lines further on. Only suffixes with an equal one take part in the next level, so it
works on less and less; it ends at the depth that the runs of interest have.

Suffixes that share their first n lines are an interval of the array with a longest common prefix of
n or more; two overlapping prefixes of 2^j lines name it, for any n. A repeated run counts from
``min_words`` words on. From each line on, and up to each line, the shortest run of that many words is
looked up; wherever its interval has an earlier member, the run is a later copy. A maximal repeated
run is the union of these runs inside it, so all of its lines are found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import Workspace

MIN_WORDS = 50
WHITE_SPACE = ("\t", "\x0b", "\x0c", "\r")


def word_count(line: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of one line."""
    for character in WHITE_SPACE:
        line = F.replace(line, F.lit(character), F.lit(" "))
    return F.size(F.array_remove(F.split(line, " "), "")).cast("long")


def line_table(docs: DataFrame, text: str) -> DataFrame:
    """A row for each line: its place, two hashes that make its id, and its words."""
    split = F.split(F.col(text), "\n")
    lines = docs.select("_id", "_row", F.posexplode(split).alias("pos", "line"))
    return lines.select(
        "_id",
        "_row",
        "pos",
        F.xxhash64("line").alias("a"),
        F.xxhash64(F.lit(7), "line").alias("b"),
        word_count(F.col("line")).alias("words"),
    )


def ranked(groups: DataFrame, *keys: str) -> DataFrame:
    """The keys with ranks in their order; ranks have gaps."""
    ordered = groups.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return ordered.select(*keys, F.monotonically_increasing_id().alias("rank"))


def repeated(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys)


def short_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """From each line, and up to each line, the shortest run of ``min_words`` words: first line and
    length. ``lines`` are those that occur repeatedly; runs have no other line in them."""
    in_text = Window.partitionBy("_row").orderBy("pos")
    lines = lines.withColumn("island", F.col("pos") - F.row_number().over(in_text))
    in_island = Window.partitionBy("_row", "island").orderBy("pos")
    lines = lines.withColumn("upto", F.sum("words").over(in_island))
    lines = lines.select("_id", "_row", "island", "pos", "upto", "words")
    before = F.col("upto") - F.col("words")
    place = ("_id", "_row", "island")
    # Starts ask for the first end that is far enough, ends for the last such start.
    starts = lines.select(*place, before.alias("words_before"), "pos")
    ends = lines.select(*place, F.col("upto").alias("words_before"), "pos")
    asks = F.lit(None).cast("int")
    forward = ends.select(*place, "words_before", F.col("pos").alias("other"), asks.alias("pos")).union(
        starts.select(*place, F.col("words_before") + min_words, asks.alias("other"), "pos")
    )
    back = starts.select(*place, "words_before", F.col("pos").alias("other"), asks.alias("pos")).union(
        ends.select(*place, F.col("words_before") - min_words, asks.alias("other"), "pos")
    )
    whole = Window.partitionBy("_row", "island")
    # The nearest one of several with as many words before it comes last, and all before the question.
    down = whole.orderBy(F.desc("words_before"), F.col("pos").asc_nulls_first(), F.desc("other"))
    up = whole.orderBy("words_before", F.col("pos").asc_nulls_first(), "other")
    nearest = F.last("other", ignorenulls=True)
    forward = forward.withColumn("found", nearest.over(down)).where("pos IS NOT NULL")
    back = back.withColumn("found", nearest.over(up)).where("pos IS NOT NULL")
    runs = forward.select("_id", "_row", F.col("pos").alias("first"), F.col("found").alias("last"))
    runs = runs.union(back.select("_id", "_row", F.col("found"), F.col("pos")))
    runs = runs.where("first IS NOT NULL AND last IS NOT NULL").distinct()
    return runs.select("_id", "_row", "first", (F.col("last") - F.col("first") + 1).alias("length"))


def named_runs(lines: DataFrame, work: Workspace, min_words: int) -> DataFrame:
    """The short runs of repeated lines with the ranks of the two prefixes, of 2^j lines, that begin
    and end them: runs of one length are equal if and only if both ranks are."""
    ids = work.keep(ranked(repeated(lines, "a", "b"), "a", "b"), "line-ids")
    active = lines.join(ids, ["a", "b"]).select("_id", "_row", "pos", "words", "rank")
    active = work.keep(active, "level")
    runs = work.keep(short_runs(active, min_words), "runs")
    longest = runs.agg(F.max("length")).first()[0] or 0
    named, depth = [], 1
    while depth <= longest or not named:
        own = F.col("length").between(depth, 2 * depth - 1)
        second = F.col("first") + F.col("length") - depth
        here = runs.where(own).withColumn("second", second)
        head = active.select("_row", F.col("pos").alias("first"), F.col("rank").alias("head"))
        tail = active.select("_row", F.col("pos").alias("second"), F.col("rank").alias("tail"))
        found = here.join(head, ["_row", "first"]).join(tail, ["_row", "second"])
        named.append(work.keep(found.drop("second"), "named"))
        if 2 * depth <= longest:
            left = active.select("_row", "pos", F.col("rank").alias("left"))
            ahead = (F.col("pos") - depth).alias("pos")
            right = active.select("_row", ahead, F.col("rank").alias("right"))
            pairs = work.keep(left.join(right, ["_row", "pos"]), "pairs")
            ids = work.keep(ranked(repeated(pairs, "left", "right"), "left", "right"), "pair-ids")
            level = pairs.join(ids, ["left", "right"]).select("_row", "pos", "rank")
            active = work.keep(level, "level")
        depth *= 2
    whole = named[0]
    for part in named[1:]:
        whole = whole.unionByName(part)
    return whole


def later_copies(named: DataFrame, work: Workspace) -> DataFrame:
    """First and last line of the runs that have an earlier, not overlapping copy; per document
    without overlaps."""
    interval = ("length", "head", "tail")
    origin = F.min(F.struct("_id", "_row", "first")).alias("origin")
    origins = named.groupBy(*interval).agg(F.count(F.lit(1)).alias("n"), origin).where("n > 1")
    later = named.join(work.keep(origins, "origins"), [*interval])
    apart = (F.col("_row") != F.col("origin._row")) | (
        F.col("first") >= F.col("origin.first") + F.col("length")
    )
    later = later.where(apart).select(
        "_row", "first", (F.col("first") + F.col("length") - 1).alias("last")
    )
    in_text = Window.partitionBy("_row").orderBy("first", "last")
    so_far = F.max("last").over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("first") <= so_far + 1, F.lit(0)).otherwise(F.lit(1))
    merged = later.withColumn("begins", begins).withColumn("part", F.sum("begins").over(in_text))
    return merged.groupBy("_row", "part").agg(F.min("first").alias("first"), F.max("last").alias("last"))


def dedup_lines(
    docs: DataFrame,
    work: Workspace,
    id_column: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """``docs`` without the later copies of line runs of ``min_words`` words or more.

    ``text`` is what is left; n_lines (before) and n_deleted are added, in place of columns of these
    names. Copies are in the order of the id and then of the lines. A copy that overlaps the first
    one stays, so the first copy of a run is always whole unless it is part of a later copy itself.

    Defined cases: a null text stays null with no lines; an empty text is one empty line; rows with
    a null id come first; rows that share an id, equal or not, are different documents in an
    arbitrary but fixed order; an empty table gives an empty result; other columns stay as they are.
    """
    own = [c for c in docs.columns if c not in ("n_lines", "n_deleted")]
    kept = docs.select(
        F.struct(*own).alias("doc"),
        F.col(id_column).alias("_id"),
        F.monotonically_increasing_id().alias("_row"),
        F.col(text).alias("_text"),
    )
    # Written once, which also fixes the row numbers; the text is stored a single time.
    rest = [c for c in own if c != text]
    kept = kept.select("_row", "_id", F.struct(F.lit(0).alias("_"), *(f"doc.{c}" for c in rest)).alias("doc"), "_text")
    kept = work.keep(kept, "documents")
    lines = work.keep(line_table(kept, "_text"), "lines")
    spans = later_copies(named_runs(lines, work, min_words), work)
    places = F.flatten(F.collect_list(F.sequence("first", "last"))).alias("deleted")
    deleted = work.keep(spans.groupBy("_row").agg(places), "deleted")
    split = F.split("_text", "\n")
    # One plan whatever the size: a join that is broadcast on small inputs only says little.
    joined = kept.join(deleted.hint("merge"), "_row", "left").withColumn("_lines", split)
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "deleted")
    left = F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n")
    columns = [
        F.when(F.col("deleted").isNull(), F.col("_text")).otherwise(left).alias(text)
        if c == text
        else F.col(f"doc.{c}").alias(c)
        for c in own
    ]
    return joined.select(
        *columns,
        F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("deleted"), F.lit(0)).cast("long").alias("n_deleted"),
    )
