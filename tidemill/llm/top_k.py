"""Exact top-k search by inner product: exhaustive term-at-a-time accumulation.

A vector is a sparse row of (dimension, integer weight) terms. Candidates and queries are cut into
blocks of bounded size, and every query block meets every candidate block once. There, each
dimension has a posting list (rows, weights); a query scatters its weighted postings, term by term,
into a dense score array over the block, from which a partition selection takes the best k. The
blocks' results are merged by a ranked window, which Spark limits on the map side.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOUND = "query_id long, vec_id long, score long, copies long"


def usable(vector: Column) -> Column:
    """True for a vector that is there and has neither null nor non-finite components."""
    limit = F.lit(float("inf"))
    fine = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (x < limit) & (x > -limit)
    )
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def integer_terms(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def postings(offsets: np.ndarray, weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each dimension the rows with a weight there and those weights."""
    lengths = np.diff(offsets)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    dims = np.arange(len(weights)) - np.repeat(offsets[:-1], lengths)
    some = weights != 0
    rows, dims, weights = rows[some], dims[some], weights[some]
    order = np.argsort(dims, kind="stable")
    ends = np.searchsorted(dims[order], np.arange(1, (lengths.max() if len(lengths) else 0)))
    return list(zip(np.split(rows[order], ends), np.split(weights[order], ends)))


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores; among equal ones the first."""
    if len(scores) <= k:
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    return np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]])


def _rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.flatten().to_numpy(zero_copy_only=False)


def block_search(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def search(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        candidates = candidates.sort_by("vec_id").combine_chunks()
        queries = queries.combine_chunks()
        out = {"query_id": [], "vec_id": [], "score": [], "copies": []}
        if len(queries) and len(candidates):
            ids = candidates["vec_id"].to_numpy()
            copies = candidates["copies"].to_numpy()
            index = postings(*_rows(candidates["terms"].chunk(0)))
            offsets, weights = _rows(queries["terms"].chunk(0))
            for n, query in enumerate(queries["vec_id"].to_numpy()):
                scores = np.zeros(len(ids), np.int64)
                for (rows, values), w in zip(index, weights[offsets[n] : offsets[n + 1]]):
                    if w == 0:
                        continue
                    if len(rows) == len(scores):  # every row has the term
                        scores += w * values
                    else:
                        scores[rows] += w * values
                other = np.flatnonzero(ids != query)
                chosen = other[best(scores[other], k)]
                out["query_id"].append(np.full(len(chosen), query))
                out["vec_id"].append(ids[chosen])
                out["score"].append(scores[chosen])
                out["copies"].append(copies[chosen])
        whole = {c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in out.items()}
        return pa.table(whole)

    return search


def top_k_search(
    vectors: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 10,
    scale: int = 1024,
    block_rows: int = 4096,
) -> DataFrame:
    """The ``k`` rows with the highest integer inner product for each row where ``is_query`` holds.

    Components become ``floor(scale * x)``. Returns query_id, rank (from 1), vec_id, score; ties go
    to the smaller vec_id, and a query with fewer candidates gets all of them.

    Defined cases: rows with a null id, a null vector, or null or non-finite components take no
    part; an empty vector scores 0, as does any dimension that one side lacks. Rows that share the
    query's id are not its candidates. A row that occurs n times with one id can fill n ranks; a
    query that occurs repeatedly is answered once for each different vector. Other columns are
    ignored, whatever their names. Scores must fit 64 bits.
    """
    rows = vectors.where(F.col(id_column).isNotNull() & usable(F.col(vector_column))).select(
        F.col(id_column).cast("long").alias("vec_id"),
        integer_terms(F.col(vector_column), scale).alias("terms"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    # Equal rows travel once, so one repeated row cannot fill a block.
    rows = rows.groupBy("vec_id", "terms", "asks").agg(F.count(F.lit(1)).alias("copies"))
    sizes = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("asks").alias("queries")
    ).first()
    n_blocks = max(1, -(-sizes["rows"] // block_rows))
    n_query_blocks = max(1, -(-sizes["queries"] // block_rows))
    own = F.xxhash64("vec_id", "terms")
    candidates = rows.select(
        F.pmod(own, F.lit(n_blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1))).alias("query_block"),
        "vec_id",
        "terms",
        "copies",
    )
    queries = rows.where("asks").select(
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
        F.pmod(own, F.lit(n_query_blocks)).cast("int").alias("query_block"),
        "vec_id",
        "terms",
    )
    pair = ("block", "query_block")
    found = (
        queries.groupBy(*pair).cogroup(candidates.groupBy(*pair)).applyInArrow(
            block_search(k), FOUND
        )
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    many = F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))).alias("copy")
    each = ranked.select("query_id", "vec_id", "score", many)
    again = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "copy")
    return (
        each.withColumn("rank", F.row_number().over(again))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
