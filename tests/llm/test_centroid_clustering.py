import hashlib

import numpy as np
import pytest

from tidemill.llm import centroid_clustering as module
from tidemill.llm.centroid_clustering import Cells, cluster_vectors, fetch, near, nearest

SCHEMA = "vec_id long, embedding array<float>, terms string, cluster int"


def clustered(spark, work, rows, **options):
    df = spark.createDataFrame([(i, v, "other", 9) for i, v in rows], SCHEMA).repartition(3)
    found = cluster_vectors(df, work, **options)
    return sorted(map(tuple, found.assigned.collect())), found


def brute(rows, dims, k, rounds, scale=64):
    kept = [
        (i, [int(np.floor(scale * float(np.float32(x)))) for x in v])
        for i, v in rows
        if i is not None and v is not None and len(v) == dims
        and all(x is not None and np.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in kept[:k]]

    def chosen(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [chosen(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            members = [v for (_, v), c in zip(kept, own) if c == n]
            if members:
                centroids[n] = [sum(x) // len(members) for x in zip(*members)]
    found = [(i, *chosen(v)) for i, v in kept]
    return sorted((i, c, d) for i, d, c in found), centroids


def vectors(seed, n, dims):
    random = np.random.default_rng(seed)
    middles = random.normal(0, 0.4, (5, dims))
    each = middles[random.integers(0, 5, n)] + random.normal(0, 0.05, (n, dims))
    return [(int(i), [float(x) for x in v]) for i, v in enumerate(each)]


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_against_brute_force(spark, work, monkeypatch, bits):
    monkeypatch.setattr(module, "BLOCK_ROWS", 64)
    monkeypatch.setattr(module, "STEP", 50)
    monkeypatch.setattr(module, "GAP", 2)
    rows = vectors(bits, 500, 8)
    got, found = clustered(spark, work, rows, dims=8, k=6, bits=bits)
    expected, centroids = brute(rows, 8, 6, 3)
    assert got == expected and found.centroids.tolist() == centroids
    assert found.fetched[0] == 500 and found.fetched[-1] <= 500


def test_clear_vectors_are_not_fetched(spark, work):
    random = np.random.default_rng(0)
    rows = []
    for i in range(400):  # two far groups, of which the hashes pick a centroid each
        rows.append((i, [float(x) for x in random.normal(3 * (i % 2), 0.02, 8)]))
    got, found = clustered(spark, work, rows, dims=8, k=2, rounds=4, bits=4)
    assert got == brute(rows, 8, 2, 4)[0]
    assert found.fetched[0] == 400 and found.fetched[-1] < 40


def test_ties_repeats_nulls_and_odd_vectors(spark, work):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 3), 0.0]) for i in range(9)] + [(4, [5.0, 5.0]), (4, [5.0, 5.0])]
    rows += [(20, [0.5, 0.0])] * 3
    odd = [(30, None), (31, []), (32, [1.0]), (33, [nan, 0.0]), (34, [-inf, 0.0]), (35, [None, 1.0])]
    odd += [(None, [1.0, 1.0]), (36, [1.0, 2.0, 3.0])]
    got, found = clustered(spark, work, rows + odd, dims=2, k=4)
    expected, centroids = brute(rows, 2, 4, 3)
    assert got == expected and found.centroids.tolist() == centroids


def test_few_vectors_and_none(spark, work):
    rows = [(1, [0.5, -0.5]), (2, [0.25, 0.0])]
    assert clustered(spark, work, rows, dims=2)[0] == brute(rows, 2, 16, 3)[0]
    assert clustered(spark, work, [], dims=2)[0] == []
    assert clustered(spark, work, [(1, None)], dims=2)[0] == []


def test_too_large_components_are_an_error(spark, work):
    with pytest.raises(ValueError, match="64 bits"):
        clustered(spark, work, [(1, [1e9, 0.0])], dims=2)


def test_intervals_hold_the_distances():
    random = np.random.default_rng(3)
    points, centroids = random.integers(-40, 40, (200, 5)), random.integers(-40, 40, (7, 5))
    ends = np.stack([np.unique(np.append(np.quantile(x, [0.2, 0.4, 0.6]), 40).astype(int)) for x in points.T])
    cells = Cells(np.hstack([np.full((5, 1), -40), ends[:, :-1] + 1]), ends, 2)
    own = cells.of(points)
    assert (cells.unpack(cells.pack(own), 200) == own).all()
    least, greatest = cells.tables(centroids)
    exact = ((points[:, None] - centroids) ** 2).sum(2)
    low = sum(least[d, own[:, d]] for d in range(5))
    high = sum(greatest[d, own[:, d]] for d in range(5))
    assert (low <= exact).all() and (exact <= high).all()
    assert near(own, least, greatest)[np.arange(200), exact.argmin(1)].all()
    assert (nearest(points, centroids, np.ones((200, 7), bool)) == exact.argmin(1)).all()


def test_fetch_reads_any_rows(tmp_path, monkeypatch):
    monkeypatch.setattr(module, "GAP", 3)
    values = np.arange(300, dtype="<i4").reshape(100, 3)
    (tmp_path / "v.i32").write_bytes(values.tobytes())
    rows = np.array([0, 1, 9, 10, 14, 50, 79])
    assert (fetch(f"{tmp_path}/v.i32", 20, rows, 3) == values[20 + rows]).all()
    assert fetch(f"{tmp_path}/v.i32", 0, rows[:0], 3).shape == (0, 3)
