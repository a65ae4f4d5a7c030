"""Approximate neighbours against all inner products."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rowguard.llm import vector_scan as V

SCHEMA = "vec_id long, embedding array<float>, label int, row long, list int, score double, asks string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, 3.0, "x") for i, v in rows], SCHEMA)


def brute(rows, every, k):
    """query row -> [(score, id)] best first."""
    best = {}
    good = [(n, i, np.array(v, dtype=np.float32).astype(float)) for n, (i, v) in enumerate(rows)]
    for n, i, q in good:
        if i is not None and i % every == 0:
            scores = [(-sum(a * b for a, b in zip(q, x)), np.inf if j is None else j) for m, j, x in good if m != n]
            best.setdefault(i, []).append([(-s, j) for s, j in sorted(scores)[:k]])
    return best


def by_query(result):
    found = {}
    for r in result.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert len(found[r["query_id"]]) == r["rank"]
    return found


def share(found, best):
    hit = sum(len({j for _, j in found.get(i, [])} & {j for _, j in lists[0]}) for i, lists in best.items())
    return hit / sum(len(lists[0]) for lists in best.values())


def clustered(count, width, seed, spread=0.4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, width))
    return [(i, (centres[rng.integers(12)] + spread * rng.standard_normal(width)).tolist()) for i in range(count)]


@pytest.mark.parametrize("kind", ["clusters", "noise", "lengths"])
def test_recall_and_scores(spark, monkeypatch, kind):
    monkeypatch.setattr(V, "LIST", 150)
    monkeypatch.setattr(V, "BLOCK", 100)
    monkeypatch.setattr(V, "QUERIES", 30)
    monkeypatch.setattr(V, "SAMPLE_ROWS", 600)
    monkeypatch.setattr(V, "SEEDS", 50)
    monkeypatch.setattr(V, "SLICE", 40)
    rows = clustered(2000, 32, 7, 0.4 if kind != "noise" else 30.0)
    if kind == "lengths":
        rows = [(i, [x * (1 + i % 9) for x in v]) for i, v in rows]
    found = by_query(V.neighbours(table(spark, rows), F.col("vec_id") % 20 == 0, k=20))
    best = brute(rows, 20, 20)
    assert set(found) == set(best) and all(len(x) == 20 for x in found.values())
    assert share(found, best) >= 0.9
    vectors = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows}
    for i, own in found.items():
        assert own == sorted(own, key=lambda x: (-x[0], x[1]))
        for score, j in own:
            assert score == pytest.approx(float(vectors[i] @ vectors[j]), rel=1e-12, abs=1e-12)


def test_given_embeddings(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in given.orderBy("vec_id").collect()]
    found = by_query(V.neighbours(given, F.col("vec_id") % 20 == 0, k=20))
    assert share(found, brute(rows, 20, 20)) >= 0.9


def test_ties_repeated_rows_and_useless_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (3, [0.5, 0.5]), (1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [0.5, -1.0]),
            (20, [0.0, 2.0]), (4, [-1.0, 0.0])]
    useless = [(5, None), (6, []), (7, [0.0, 0.0]), (40, [nan, 1.0]), (60, [inf, 1.0]), (8, [None, 1.0]),
               (80, [1.0, 1.0, 1.0])]
    found = by_query(V.neighbours(table(spark, rows + useless), F.col("vec_id") % 20 == 0, k=20))
    assert found == {
        0: [(0.5, 1), (0.5, 1), (0.5, 3), (0.5, None), (0.0, 20), (-1.0, 4)],
        20: [(1.0, 3), (0.5, 1), (0.5, 1), (0.0, 0), (-0.0, 4), (-2.0, None)],
    }
    again = V.neighbours(table(spark, rows + rows[:1]), F.col("vec_id") % 20 == 0, k=2).collect()
    assert sorted((r["rank"], r["score"], r["vec_id"]) for r in again if r["query_id"] == 0) == [
        (1, 1.0, 0), (1, 1.0, 0), (2, 0.5, 1), (2, 0.5, 1)
    ]


def test_empty_tables(spark):
    for rows in ([], [(0, None)], [(0, [0.0])]):
        assert V.neighbours(table(spark, rows), F.col("vec_id") % 20 == 0).collect() == []
    assert V.neighbours(table(spark, [(1, [1.0])]), F.col("vec_id") % 20 == 0).collect() == []
    assert V.neighbours(table(spark, [(0, [1.0])]), F.col("vec_id") % 20 == 0).collect() == []


def test_equal_vectors_of_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(V, "LIST", 100)
    monkeypatch.setattr(V, "BLOCK", 50)
    monkeypatch.setattr(V, "SAMPLE_ROWS", 400)
    monkeypatch.setattr(V, "SEEDS", 30)
    rows = clustered(600, 16, 3) + [(600 + i, [0.25] * 16) for i in range(300)]
    found = by_query(V.neighbours(table(spark, rows), F.col("vec_id") % 20 == 0, k=10))
    best = brute(rows, 20, 10)
    for i in range(600, 900, 20):
        assert found[i] == best[i][0] or share({i: found[i]}, {i: best[i]}) >= 0.9
    assert share(found, best) >= 0.9


def test_scan_gives_up_early_but_keeps_what_counts():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((20_000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    turn = V._rotation(64)
    kept = lost = 0
    for q in x[:50]:
        scores = x @ q
        threshold = np.sort(scores)[-21]
        left = V.scan(x @ turn, np.linalg.norm(x, axis=1), q @ turn, threshold)
        true = set(np.flatnonzero(scores >= threshold))
        lost += len(true - set(left))
        kept += len(true)
        assert len(set(left) - true) <= 1e-9 * len(x)
    assert lost <= 0.03 * kept


@pytest.mark.parametrize("sparse", [0.0, 0.125, 1.0])
def test_scanning_for_many_queries_at_once(monkeypatch, sparse):
    """Pairs are those of a plain loop over queries and blocks of columns if taken singly; together, none
    of those is given up, and all that are left reach the threshold."""
    monkeypatch.setattr(V, "SPARSE", sparse)
    rng = np.random.default_rng(5)
    x, q = rng.standard_normal((700, 24)), rng.standard_normal((40, 24))
    x[:100] = x[0]
    thresholds = np.sort(q @ x.T, axis=1)[:, -30]
    thresholds[3], thresholds[4] = -np.inf, 1e9
    norms, want = np.linalg.norm(x, axis=1), set()
    for i, (query, threshold) in enumerate(zip(q, thresholds)):
        left = np.arange(len(x))
        for end in (6, 12, 18, 24):
            share = end * (24 - end) / (24 * 23 * 26.0)
            own = np.linalg.norm(query) * norms[left]
            aim = threshold if np.isfinite(threshold) else 0.0
            slack = V.DEVIATIONS * np.sqrt(share * (own**2 + aim**2)) + 1e-9 * own
            left = left[x[left, :end] @ query[:end] >= threshold * (end / 24) - slack]
        want |= {(i, j) for j in left}
    who, whom = V.scan_pairs(x, norms, q, thresholds)
    assert set(zip(who, whom)) >= want and len(who) == len(set(zip(who, whom)))
    assert ((q[who] * x[whom]).sum(axis=1) >= thresholds[who] - 1e-6).all()
    assert sparse < 1 or len(who) == len(want)
    assert sum(i == 3 for i, _ in want) == len(x) and not any(i == 4 for i, _ in want)


def test_a_cell_scans_for_its_queries_together(monkeypatch):
    """Passes over a block of columns do not grow with the single queries of a cell; ties, rows of the
    queries themselves and seeds are treated as if each query went alone."""
    monkeypatch.setattr(V, "SLICE", 50)
    monkeypatch.setattr(V, "BATCH", 32)
    rng = np.random.default_rng(6)
    x = rng.integers(-2, 3, (180, 8)).astype(float)
    x[(x == 0).all(axis=1)] = 1.0
    ids = pa.array([None if i == 7 else i // 2 for i in range(180)], pa.int64())
    rows = pa.array(np.arange(180))
    vec = pa.array(x.tolist(), pa.list_(pa.float64()))
    block = pa.table({"row": rows, "vec_id": ids, "vec": vec})
    asking = np.arange(0, 180, 2)
    queries = block.take(pa.array(asking)).append_column("threshold", pa.array(np.full(90, -np.inf)))
    passes, plain = [], V.scan_pairs
    monkeypatch.setattr(V, "scan_pairs", lambda *a: passes.append(1) or plain(*a))
    seeds = np.array([5, 6])
    found = {}
    for r in V._cell(block, queries, seeds, 4).to_pylist():
        found.setdefault(r["query_row"], []).append((-r["score"], r["row"]))
    assert len(passes) == 3 * 4
    order = [np.inf if i is None else i for i in ids.to_pylist()]
    for row in asking:
        others = [(-float(x[row] @ x[j]), order[j], j) for j in range(180) if j != row and j not in (5, 6)]
        assert sorted(found[row]) == sorted((s, j) for s, _, j in sorted(others)[:4])
