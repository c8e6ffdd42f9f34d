"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted once for each cell of the dimensions (source, language, topic, ...). Raking then
scales the cells so that their sums along each dimension meet that dimension's targets, one dimension
after the other, again and again. As every step multiplies whole slices, a cell's weight is its tokens
times one factor of each dimension, and only these factors, one for each value, are recomputed.
Documents are sampled with a probability in proportion to their cell's factors; of the cells with
tokens the one that lacks most is kept whole.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import Workspace

# Sweeps of the SQL that op7 must agree with.
ITERATIONS = 8
# Raking ends when a sweep changes the proportions within no dimension by more than this.
TOLERANCE = 1e-6
# Sweeps that together lower the change by less than one percent: the targets cannot all be met.
STALLED = 20


@dataclass(frozen=True)
class Tempered:
    """Target shares in proportion to the shares there are, to the power ``exponent``: 1 leaves them
    as they are, 0 makes all values weigh alike."""

    exponent: float


def label(value: Column) -> Column:
    """A dimension's value as text; null is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("null"))


def uniform(id_: Column, salt: str = "") -> Column:
    """A number from 0 to 1 that only depends on the id."""
    digest = F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def target_table(cells: DataFrame, name: str, target: Tempered | DataFrame) -> DataFrame:
    """label and share for each value that has cells; shares add up to 1."""
    sums = cells.groupBy(F.col(name).alias("label")).agg(F.sum("tokens").cast("double").alias("have"))
    if isinstance(target, Tempered):
        # Values without tokens have no share.
        share = F.when(F.col("have") > 0, F.pow(F.col("have"), F.lit(target.exponent)))
        wanted = sums.select("label", F.coalesce(share, F.lit(0.0)).alias("share"))
    else:
        given = target.select(label(F.col("value")).alias("label"), F.col("share").cast("double"))
        wanted = sums.join(given, "label", "left").select(
            "label", F.coalesce("share", F.lit(0.0)).alias("share")
        )
    total = wanted.agg(F.sum("share")).first()[0] or 1.0
    return wanted.select("label", (F.col("share") / F.lit(total)).alias("share"))


def rake(
    cells: DataFrame,
    targets: dict[str, Tempered | DataFrame],
    work: Workspace,
    iterations: int | None = None,
    tolerance: float = TOLERANCE,
) -> dict[str, DataFrame]:
    """For each dimension its values with the factor that raking gives them (label, factor).

    ``cells`` has a column of labels for each dimension, and tokens. Values without tokens in any cell
    that still has weight keep factor 1.

    Sweeps go on until one changes the proportions within no dimension by more than ``tolerance`` of
    themselves, so each dimension meets its targets up to that for every other dimension. Targets that
    contradict each other are never met; raking ends when sweeps no longer bring them closer. With
    ``iterations`` there are exactly that many sweeps. Either way a change left above ``tolerance`` is
    told by a warning.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    shares = {d: work.keep(target_table(cells, d, t), f"target-{d}") for d, t in targets.items()}
    factors = {
        d: work.keep(share.select("label", F.lit(1.0).alias("factor")), f"factor-{d}")
        for d, share in shares.items()
    }
    sweeps, least, since, left = 0, float("inf"), 0, float("inf")
    while sweeps != iterations and left > tolerance and since < STALLED:
        for d in targets:
            weight, rows = F.col("tokens").cast("double"), cells
            for other in targets:
                if other != d:
                    rows = rows.join(factor_column(factors[other], other), other)
                    weight = weight * F.col(f"factor_{other}")
            sums = rows.groupBy(F.col(d).alias("label")).agg(F.sum(weight).alias("weight"))
            wanted = F.col("share") * F.lit(total) / F.col("weight")
            factor = F.when(F.col("weight") > 0, wanted).otherwise(F.lit(1.0))
            before = factors[d].select("label", F.col("factor").alias("before"))
            change = F.when((F.col("weight") > 0) & (F.col("share") > 0), factor / F.col("before"))
            new = shares[d].join(sums, "label").join(before, "label")
            new = new.select("label", factor.alias("factor"), change.alias("change"))
            factors[d] = work.replace(new, f"factor-{d}")
        sweeps += 1
        if iterations is None or sweeps == iterations:
            left = largest_change(list(factors.values()))
            since = 0 if left < 0.99 * least else since + 1
            least = left if since == 0 else least
    if left > tolerance:
        warnings.warn(f"after {sweeps} sweeps a target is missed by up to {left:.1e} of itself")
    return factors


def largest_change(factors: list[DataFrame]) -> float:
    """How far the last step of any dimension moved its values against each other."""
    spread = (F.max("change") / F.min("change") - 1).alias("spread")
    spreads = reduce(DataFrame.union, [f.agg(spread) for f in factors])
    return spreads.agg(F.max("spread")).first()[0] or 0.0


def factor_column(factors: DataFrame, name: str) -> DataFrame:
    return factors.select(F.col("label").alias(name), F.col("factor").alias(f"factor_{name}"))


def mix(
    docs: DataFrame,
    targets: dict[str, Tempered | DataFrame],
    tokens: Column,
    work: Workspace,
    id_column: str = "doc_id",
    iterations: int | None = None,
) -> DataFrame:
    """``docs`` with ``probability``, by which a sample meets the targets in expectation, and
    ``sampled``, whether the document is in the sample.

    ``targets`` names dimensions, which are columns of ``docs``, and gives for each a ``Tempered`` or
    a table of value and share. ``tokens`` counts a document's tokens. ``iterations``: see ``rake``.

    Defined cases: a null value of a dimension is a value like any other; a value that the given
    targets lack has share 0 and is not sampled; documents without tokens get the probability of
    their cell, and a cell without any tokens does not lower that of others; rows that share an id, equal or not, are in the sample together as far as their
    probabilities are equal; with a null id a row is treated like one with an empty id; an empty table
    gives an empty result; columns named probability or sampled are replaced.
    """
    own = [c for c in docs.columns if c not in ("probability", "sampled")]
    dims = {d: label(F.col(d)) for d in targets}
    counted = docs.select(*(v.alias(d) for d, v in dims.items()), tokens.alias("tokens"))
    cells = counted.groupBy(*dims).agg(F.sum("tokens").alias("tokens"))
    cells = work.keep(cells, "cells")
    factors = rake(cells, targets, work, iterations)
    ratio, rows = F.lit(1.0), cells
    for d in targets:
        rows = rows.join(factor_column(factors[d], d), d)
        ratio = ratio * F.col(f"factor_{d}")
    names = {d: f"_cell_{n}" for n, d in enumerate(targets)}
    labels = [F.col(d).alias(n) for d, n in names.items()]
    rows = work.keep(rows.select(*labels, "tokens", ratio.alias("_ratio")), "ratios")
    most = rows.where("tokens > 0").agg(F.max("_ratio")).first()[0] or 1.0
    rows = rows.drop("tokens")
    joined = docs.select(F.struct(*own).alias("doc"), *(dims[d].alias(n) for d, n in names.items()))
    joined = joined.join(rows, list(names.values()))
    probability = F.least(F.col("_ratio") / F.lit(most), F.lit(1.0))
    return joined.select(
        "doc.*",
        probability.alias("probability"),
        (uniform(F.col(f"doc.{id_column}")) < probability).alias("sampled"),
    )


def with_topic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the topic that their embedding, if there is one, is labelled with; a column
    topic is replaced."""
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    topics = embeddings.groupBy(F.col("vec_id").alias("doc_id")).agg(F.min("label").alias("topic"))
    return docs.drop("topic").join(topics.hint("merge"), "doc_id", "left")  # one plan whatever the size
