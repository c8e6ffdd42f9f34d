"""Clustering of vectors around centroids over a vector-approximation (VA) file.

Vectors become integers. They are written once to plain files of the shared folder, from which any
of them can be read alone, and beside them an approximation: a few-bit cell for each dimension, cells
being about equally full. In each round a task reads approximations only. Tables with the least and
greatest squared difference of every cell from every centroid, dimension by dimension, add up to an
interval of the distance from each centroid. Where one interval lies below all others, its centroid is
the nearest; where intervals overlap, the full vectors are fetched and compared exactly.

Centroid sums are kept up to date by vectors that change their centroid: only these are fetched for it,
which are all in the first round and fewer and fewer afterwards. The last round reads all vectors again,
for the distance from their one centroid.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import Workspace
from tidemill.llm.token_files import _filesystem
from tidemill.llm.top_k import integer_terms, usable

# Vectors in one row of the approximation table.
BLOCK_ROWS = 8192
# Distances that are in memory at once.
STEP = 1 << 20
# Vectors nearer to each other than this in the file are fetched by one read.
GAP = 64
# Share of a dimension's values in either outer cell, and how exactly it is found.
TAIL, ACCURACY = 0.001, 10_000
# Squared distances of up to 256 components of this size fit 64 bits.
LARGEST = 1 << 26

BLOCKS = "file string, first long, ids array<long>, cells binary, chosen binary"
PASSED = BLOCKS + ", sums array<long>, fetched long"
ASSIGNED = "vec_id long, cluster int, distance long"


@dataclass
class Cells:
    """Least and greatest value of each dimension's cells, filled up with copies of the last one."""

    low: np.ndarray
    high: np.ndarray
    bits: int

    def of(self, vectors: np.ndarray) -> np.ndarray:
        columns = zip(self.high, vectors.T)
        return np.stack([np.searchsorted(high, x) for high, x in columns], 1).astype(np.uint8)

    def pack(self, cells: np.ndarray) -> bytes:
        return np.packbits(cells[:, :, None] >> np.arange(self.bits, dtype=np.uint8) & 1).tobytes()

    def unpack(self, data: bytes, rows: int) -> np.ndarray:
        dims = len(self.low)
        bits = np.unpackbits(np.frombuffer(data, np.uint8), count=rows * dims * self.bits)
        weights = 1 << np.arange(self.bits, dtype=np.uint8)
        return (bits.reshape(rows, dims, self.bits) * weights).sum(2, dtype=np.uint8)

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest squared difference by dimension, cell and centroid."""
        below = self.low[:, :, None] - centroids.T[:, None, :]
        above = centroids.T[:, None, :] - self.high[:, :, None]
        least = np.maximum(0, np.maximum(below, above)) ** 2
        return least, np.maximum(np.abs(below), np.abs(above)) ** 2


def fit_cells(kept: DataFrame, dims: int, bits: int) -> Cells | None:
    """Cells of each dimension over all vectors; None without vectors. All but the outer two are of
    one width, and about a thousandth of the values are in each of these, so that a few far values
    do not widen the others. The bounds decide how many vectors are fetched, never the result."""
    columns = []
    for d in range(dims):
        x = F.col("terms")[d]
        columns += [F.min(x), F.percentile_approx(x, [TAIL, 1 - TAIL], ACCURACY), F.max(x)]
    row = kept.agg(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first()
    if row[0] is None:
        return None
    if min(row[::3]) < -LARGEST or max(row[2::3]) > LARGEST:
        raise ValueError(f"components beyond {LARGEST}: squared distances might not fit 64 bits")
    low = np.empty((dims, 1 << bits), np.int64)
    high = np.empty((dims, 1 << bits), np.int64)
    for d in range(dims):
        least, (begin, end), greatest = row[3 * d : 3 * d + 3]
        cuts = np.floor(np.linspace(begin, end, (1 << bits) - 1)).astype(np.int64)
        ends = np.unique(np.append(cuts, greatest))
        begins = np.append(least, ends[:-1] + 1)
        high[d], low[d] = np.pad(ends, (0, (1 << bits) - len(ends)), "edge"), begins[-1]
        low[d, : len(begins)] = begins
    return Cells(low, high, bits)


# --- vectors in files ----------------------------------------------------------------------------


def write_blocks(kept: DataFrame, cells: Cells, work: Workspace) -> DataFrame:
    """Vectors to files, a file for each task, and the table of their approximations."""
    folder = work.path("vectors")
    shared = kept.sparkSession.sparkContext.broadcast(cells)  # dims times cells, fixed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, first = None, 0
        for whole in batches:
            for start in range(0, len(whole), BLOCK_ROWS):
                batch = whole.slice(start, BLOCK_ROWS)
                if sink is None:
                    filesystem, root = _filesystem(folder)
                    filesystem.create_dir(root, recursive=True)
                    # An attempt that is repeated writes another file; rows name the one that counts.
                    name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.i32"
                    sink = filesystem.open_output_stream(f"{root}/{name}")
                flat = batch.column(1).flatten().to_numpy()
                vectors = flat.reshape(len(batch), -1)
                sink.write(flat.astype("<i4").tobytes())
                row = [
                    pa.array([f"{folder}/{name}"]),
                    pa.array([first]),
                    pa.ListArray.from_arrays([0, len(batch)], batch.column(0)),
                    pa.array([shared.value.pack(shared.value.of(vectors))], pa.binary()),
                    pa.array([np.full(len(batch), -1, "<i4").tobytes()], pa.binary()),
                ]
                first += len(batch)
                names = ["file", "first", "ids", "cells", "chosen"]
                yield pa.RecordBatch.from_arrays(row, names=names)
        if sink is not None:
            sink.close()

    return work.keep(kept.select("vec_id", "terms").mapInArrow(run, BLOCKS), "blocks")


def fetch(file: str, first: int, rows: np.ndarray, dims: int) -> np.ndarray:
    """The vectors at ascending ``rows`` behind row ``first`` of a file, few reads for near ones."""
    out = np.empty((len(rows), dims), np.int64)
    if not len(rows):
        return out
    folder, _, name = file.rpartition("/")
    filesystem, root = _filesystem(folder)
    with filesystem.open_input_file(f"{root}/{name}") as source:
        edges = np.flatnonzero(np.diff(rows) > GAP) + 1
        for part in np.split(np.arange(len(rows)), edges):
            begin, end = int(rows[part[0]]), int(rows[part[-1]]) + 1
            data = source.read_at((end - begin) * dims * 4, (first + begin) * dims * 4)
            out[part] = np.frombuffer(data, "<i4").reshape(-1, dims)[rows[part] - begin]
    return out


# --- rounds --------------------------------------------------------------------------------------


def near(cells: np.ndarray, least: np.ndarray, greatest: np.ndarray) -> np.ndarray:
    """For each vector and centroid whether its distance interval reaches below the others' ends."""
    rows, k = len(cells), least.shape[2]
    out = np.empty((rows, k), bool)
    step = max(1, STEP // k)
    for a in range(0, rows, step):
        part = cells[a : a + step]
        low, high = np.zeros((2, len(part), k), np.int64)
        for d in range(cells.shape[1]):
            low += least[d, part[:, d]]
            high += greatest[d, part[:, d]]
        out[a : a + step] = low <= high.min(1)[:, None]
    return out


def nearest(vectors: np.ndarray, centroids: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """The candidate with the least squared distance, of equal ones the first."""
    row, centroid = np.nonzero(candidates)
    distance = np.empty(len(row), np.int64)
    step = max(1, STEP // vectors.shape[1])
    for a in range(0, len(row), step):
        part = slice(a, a + step)
        distance[part] = ((vectors[row[part]] - centroids[centroid[part]]) ** 2).sum(1)
    order = np.lexsort((centroid, distance, row))
    return centroid[order[np.searchsorted(row, np.arange(len(vectors)))]]


def assign(
    block: dict, centroids: np.ndarray, cells: Cells, tables: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each vector's centroid, and the rows that had to be fetched with their vectors."""
    packed = cells.unpack(block["cells"], len(block["ids"]))
    candidates = near(packed, *tables)
    chosen = candidates.argmax(1)
    unclear = np.flatnonzero(candidates.sum(1) > 1)
    vectors = fetch(block["file"], block["first"], unclear, centroids.shape[1])
    chosen[unclear] = nearest(vectors, centroids, candidates[unclear])
    return chosen, unclear, vectors


def one_round(blocks: DataFrame, centroids: np.ndarray, cells: Cells) -> DataFrame:
    """New centroids of all vectors, and by block what they change in the centroids' counts and sums."""
    shared = blocks.sparkSession.sparkContext.broadcast((centroids, cells))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, cells = shared.value
        tables, k = cells.tables(centroids), len(centroids)
        for batch in batches:
            for n in range(len(batch)):
                row = batch.slice(n, 1)
                block = row.to_pylist()[0]
                chosen, fetched, vectors = assign(block, centroids, cells, tables)
                before = np.frombuffer(block["chosen"], "<i4")
                moved = np.flatnonzero(chosen != before)
                rest = np.setdiff1d(moved, fetched, assume_unique=True)
                held = np.concatenate([fetched, rest])
                more = fetch(block["file"], block["first"], rest, centroids.shape[1])
                vectors = np.concatenate([vectors, more])[np.isin(held, moved)]
                held = held[np.isin(held, moved)]
                change = np.zeros((k, 1 + centroids.shape[1]), np.int64)
                ones = np.hstack([np.ones((len(held), 1), np.int64), vectors])
                np.add.at(change, chosen[held], ones)
                left = before[held] >= 0
                np.subtract.at(change, before[held][left], ones[left])
                sums = pa.array([change.ravel()], pa.list_(pa.int64()))
                state = pa.array([chosen.astype("<i4").tobytes()], pa.binary())
                count = pa.array([len(fetched) + len(rest)], pa.int64())
                columns = [*row.columns[:4], state, sums, count]
                yield pa.RecordBatch.from_arrays(columns, names=[*row.schema.names[:5], "sums", "fetched"])

    return blocks.mapInArrow(run, PASSED)


def last_round(blocks: DataFrame, centroids: np.ndarray, cells: Cells) -> DataFrame:
    """vec_id, cluster and exact squared distance of all vectors."""
    shared = blocks.sparkSession.sparkContext.broadcast((centroids, cells))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, cells = shared.value
        tables = cells.tables(centroids)
        for batch in batches:
            for n in range(len(batch)):
                block = batch.slice(n, 1).to_pylist()[0]
                chosen = assign(block, centroids, cells, tables)[0]
                rows = np.arange(len(chosen))
                vectors = fetch(block["file"], block["first"], rows, centroids.shape[1])
                distance = ((vectors - centroids[chosen]) ** 2).sum(1)
                ids = pa.array(block["ids"], pa.int64())
                columns = [ids, pa.array(chosen, pa.int32()), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return blocks.mapInArrow(run, ASSIGNED)


@dataclass
class Clustering:
    """``assigned`` has vec_id, cluster and squared distance; ``fetched`` is how many full vectors
    each round but the last one read."""

    assigned: DataFrame
    centroids: np.ndarray
    fetched: list[int]


def cluster_vectors(
    vectors: DataFrame,
    work: Workspace,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    dims: int = 64,
    scale: int = 64,
    k: int = 16,
    rounds: int = 3,
    bits: int = 6,
    salt: str = "1:",
) -> Clustering:
    """Lloyd's rounds with integer centroids, over cells of ``bits`` bits.

    Vectors of exactly ``dims`` components become ``floor(scale * x)``. The ``k`` of them with the
    smallest sha256 of salt and id are the first centroids, in this order. Each round gives every
    vector to the nearest centroid (ties: the smaller number) and makes each non-empty centroid the
    floor of its vectors' mean, exactly; then vectors are given to centroids once more.

    Defined cases: rows with a null id, a null vector, another number of components, or null or
    non-finite components take no part. Repeated rows take part each; first centroids of one hash are
    ordered by their vectors. Fewer than ``k`` vectors give as many centroids, none an empty result.
    Other columns are ignored, whatever their names. Scaled components beyond 2 ** 26 are an error.
    """
    usual = F.col(id_column).isNotNull() & usable(F.col(vector_column))
    kept = vectors.where(usual & (F.size(vector_column) == dims)).select(
        F.col(id_column).cast("long").alias("vec_id"),
        integer_terms(F.col(vector_column), scale).alias("terms"),
    )
    spark = vectors.sparkSession
    cells = fit_cells(kept, dims, bits)
    if cells is None:
        none = spark.createDataFrame([], ASSIGNED)
        return Clustering(none, np.zeros((0, dims), np.int64), [])
    hashed = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(hashed, "terms").limit(k).collect()
    centroids = np.array([r["terms"] for r in first], np.int64)
    blocks = write_blocks(kept, cells, work)
    totals = np.zeros((len(centroids), 1 + dims), np.int64)
    fetched = []
    for _ in range(rounds):
        blocks = work.replace(one_round(blocks, centroids, cells), "round")
        change = blocks.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("by"))
        for pos, by in change.collect():  # k times dims + 1
            totals.flat[pos] += by
        fetched.append(blocks.agg(F.sum("fetched")).first()[0])
        some = totals[:, 0] > 0
        centroids = centroids.copy()
        centroids[some] = totals[some, 1:] // totals[some, :1]
    assigned = work.keep(last_round(blocks, centroids, cells), "assigned")
    return Clustering(assigned, centroids, fetched)
