"""The index of cells against exact neighbours."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import cells, knn
from tidemark.plans import adapters as A
from tidemark.plans import analytics
from tidemark.sources.tables import checkpointed


def pairs(df):
    return sorted((r["new_id"], r["historical_id"], round(r["similarity"], 9), r["rank"]) for r in df.collect())


@pytest.fixture(scope="module")
def vectors(spark):
    r = np.random.default_rng(1)
    middle = r.normal(size=(12, 16))
    rows = [(f"v{i:04d}", [float(x) for x in middle[i % 12 if i % 3 else 0] + 0.35 * r.normal(size=16)]) for i in range(1500)]
    rows += [("zero", [0.0] * 16), ("none", None), ("twin", rows[7][1])]
    return spark.createDataFrame(rows, "id string, embedding array<float>")


@pytest.fixture(scope="module")
def index(vectors):
    found = cells.centres(vectors, 24)
    return found, checkpointed(cells.indexed(vectors, found), "cells")


def test_every_vector_is_in_one_cell(vectors, index):
    found, table = index
    assert found.shape == (24, 16) and np.allclose(np.linalg.norm(found, axis=1), 1)
    assert table.count() == table.select("id").distinct().count() == 1502 and table.where("cell < 0 or cell >= 24").count() == 0


def test_recall(vectors, index):
    found, table = index
    queries = vectors.where("id like 'v%0'")
    exact = knn.top_k(queries, vectors, 5, exclude_self=True)
    got = cells.recall(cells.nearest(queries, table, found, 5, probes=6), exact)
    assert got >= 0.95
    assert cells.recall(cells.nearest(queries, table, found, 5, probes=1), exact) < got


def test_all_cells_are_exact_and_tiles_agree(vectors, index, monkeypatch):
    found, table = index
    queries = vectors.where("id like 'v%00' or id in ('zero', 'none', 'twin')")
    exact = pairs(knn.top_k(queries, vectors, 4, exclude_self=True))
    assert pairs(cells.nearest(queries, table, found, 4, probes=24)) == exact
    monkeypatch.setattr(cells, "CELL_TILE", 20)
    monkeypatch.setattr(cells, "QUERY_TILE", 5)
    assert pairs(cells.nearest(queries, table, found, 4, probes=24)) == exact


def test_no_vectors(vectors, index):
    found, table = index
    empty = vectors.limit(0)
    assert cells.nearest(empty, table, found).count() == 0 and cells.nearest(vectors, table.limit(0), found).count() == 0
    none = cells.centres(empty)
    assert cells.indexed(vectors, none).count() == 1502


def test_recall_on_the_tables(spark, small):
    vectors = A.vectors(spark, small)
    found = cells.centres(vectors, 16)
    exact = knn.top_k(vectors, None, 3, exclude_self=True)
    assert cells.recall(cells.nearest(vectors, cells.indexed(vectors, found), found, 3, probes=12), exact) >= 0.95


def test_best_places():
    s = np.round(np.random.default_rng(3).normal(size=(50, 30)), 1)
    for k in (1, 3, 30, 40):
        row, column = knn.best_places(s, k)
        want = np.argsort(-s, axis=1, kind="stable")[:, :k]
        assert (column.reshape(50, -1) == want).all() and (row == np.repeat(np.arange(50), want.shape[1])).all()


def test_the_query_looks_into_all_cells(spark, small, monkeypatch):
    monkeypatch.setattr(cells, "CELL", 20)  # more cells than PROBES
    assert len(cells.centres(A.vectors(spark, small))) > cells.PROBES
    assert pairs(analytics.knn_cells_topk(spark, small)) == pairs(knn.top_k(A.vectors(spark, small), None, exclude_self=True))


def test_expressions_agree_with_tiles_and_many_pairs_go_by_tiles(vectors, monkeypatch):
    queries = vectors.where("id like 'v%0' or id in ('zero', 'none', 'twin')")
    exact, by_expressions = pairs(knn.top_k(queries, vectors)), knn.top_k_by_expressions(queries, vectors)
    assert pairs(by_expressions) == exact and len(exact) > 100
    used = []
    monkeypatch.setattr(knn, "top_k", lambda *a, **k: used.append(a))
    monkeypatch.setattr(knn, "EXPRESSION_PAIRS", 1000)
    knn.top_k_by_expressions(queries, vectors)
    assert len(used) == 1


def test_the_best_of_a_tile_come_from_a_few_candidates():
    r = np.random.default_rng(6)
    h, q = knn.unit(r.normal(size=(3000, 16))), knn.unit(r.normal(size=(40, 16)))
    h[100:140], h[2500:2520], q[3] = h[7], h[9], h[7]  # ties
    for decimals in (None, 1, 6):
        for k in (1, 3, 200):
            row, column, s = knn.best_near(q, h, h.astype(np.float32), k, decimals)
            exact = q @ h.T if decimals is None else np.round(q @ h.T, decimals)
            x, y = knn.best_places(np.round(exact, 12), k)
            assert np.allclose(s, exact[x, y], atol=1e-12) and (row == x).all() and (decimals is None or (column == y).all())
    assert len(knn.near_places((q @ h.T).astype(np.float32), 3, knn.SINGLE)[0]) < 0.05 * len(q) * len(h)


def test_ids_of_one_table_are_computed_once(spark, vectors):
    from tidemark.operators import ingest

    found = knn.top_k(vectors, None).selectExpr("new_id as new_episode_id", "historical_id as historical_episode_id")
    ids = ingest.distinct_ids(found, found)
    assert ids._jdf.queryExecution().optimizedPlan().toString().count("FlatMapCoGroupsInArrow") == 1
    assert sorted(r[0] for r in ids.collect()) == sorted({x for r in found.collect() for x in r})
