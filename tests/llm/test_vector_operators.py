"""Embedding near-dedup and nearest-neighbour search against brute force."""

import numpy as np
import pytest

from tablesmith.llm import ann_tree, embedding_dedup
from tablesmith.llm.queries import op5_embedding_dedup, op8_ann_search

SCHEMA = "vec_id long, embedding array<float>, label int, n long, `group` string, leaf string"


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute_links(rows, threshold=0.98):
    n = len(rows)
    links, parent = [0] * n, list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            (a, x, k), (b, y, m) = rows[i][:3], rows[j][:3]
            if k is None or k != m or not usable(x) or not usable(y) or len(x) != len(y):
                continue
            x, y = np.float64(x), np.float64(y)
            if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links[i] += 1
                links[j] += 1
                p, q = root(i), root(j)
                low, high = sorted((p, q), key=lambda r: rows[r][0])
                parent[high] = low
    return {rows[i][0]: (links[i], rows[root(i)][0], root(i) == i) for i in range(n)}


def vectors(seed, dim=16):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(30):
        centre = rng.normal(size=dim)
        for _ in range(int(rng.integers(1, 14))):
            x = centre + rng.normal(size=dim) * rng.choice([0.0, 0.05, 0.12, 0.2])
            rows.append((np.float32(x * rng.uniform(0.1, 9)).tolist(), int(c % 3)))
    rows += [(rows[0][0], rows[0][1])] * 25
    rows += [(None, 1), ([0.0] * dim, 1), ([1.0] * (dim - 1) + [None], 1), ([1.0] * (dim - 1) + [float("nan")], 1), ([float("inf")] * dim, 1)]
    rows += [(rows[5][0], None), (rows[5][0][:8], 1), (rows[5][0][:8], 1), ([1.0], 1), ([2.0], 1), ([-1.0], 1)]
    order = rng.permutation(len(rows))
    return [(int(i) * 3 - 60, *rows[int(o)]) for i, o in enumerate(order)]


@pytest.mark.parametrize("tile", [2048, 12])
def test_links_and_components_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)  # small tiles: many pivots, tiles and pruned pairs
    rows = vectors(tile)
    got = embedding_dedup.near_duplicates(spark.createDataFrame([(*r, 1, "g", "l") for r in rows], SCHEMA)).collect()
    assert len(got) == len(rows)
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == brute_links(rows)


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 48)) ** 3
    t = embedding_dedup.Tile(np.arange(300), np.ones(300, dtype=np.int64), x)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    approx = (t.floats @ t.floats.T).astype(np.float64) * t.scale[:, None] * t.scale[None]
    bound = t.rest[:, None] * t.back[None] + t.rest[None]
    assert (np.abs(unit @ unit.T - approx) <= bound + 1e-12).all() and bound.max() < 0.1


def test_embedding_edges(spark):
    rows = [(5, [1.0, 0.0], 1, 1, "", ""), (5, [1.0, 0.0], 1, 1, "", ""), (None, [1.0, 0.0], 1, 1, "", ""), (4, [1.0, 0.01], 1, 1, "", "")]
    got = sorted(map(tuple, embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == [(4, 2, 4, True), (5, 2, 4, False), (5, 2, 4, False), (None, 0, None, True)]
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_embedding_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in op5_embedding_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert got == brute_links(rows)


def brute_nearest(rows, is_query, k=10):
    out = {}
    good = [(i, np.float64(x)) for i, x, *_ in rows if i is not None and usable(x)]
    for q, x in good:
        if is_query(q):
            near = sorted((float(np.sqrt(((y - x) ** 2).sum())), i) for i, y in good if i != q and len(y) == len(x))
            out[q] = near[:k]
    return out


def recall(got, want):
    return sum(len({i for _, i in want[q]} & {i for _, i in got.get(q, [])}) for q in want) / max(1, sum(map(len, want.values())))


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_search_finds_the_nearest(spark, monkeypatch):
    monkeypatch.setattr(ann_tree, "LEAF", 8)  # many leaves
    monkeypatch.setattr(ann_tree, "CHUNK", 16)
    rows = vectors(5)
    got = found(ann_tree.nearest(spark.createDataFrame([(*r, 1, "g", "l") for r in rows], SCHEMA), lambda v: v % 2 == 0))
    want = brute_nearest(rows, lambda i: i % 2 == 0)
    assert set(got) == set(want) and recall(got, want) >= 0.9
    by_id = {i: np.float64(x) for i, x, _ in rows if usable(x)}
    for q, near in got.items():
        assert near == sorted(near)
        for d, i in near:
            assert i != q and d == pytest.approx(float(np.sqrt(((by_id[q] - by_id[i]) ** 2).sum())), rel=1e-14)


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 2.0], 1, 1, "", "") for i in range(40)] + [(100, [1.0, 2.5], 1, 1, "", "")]
    got = found(ann_tree.nearest(spark.createDataFrame(rows, SCHEMA), lambda v: v % 100 == 0))
    assert got[0] == [(0.0, i) for i in range(1, 11)] and got[100] == [(0.5, i) for i in range(10)]


def test_search_edges(spark):
    few = [(0, [1.0, 0.0], 1, 1, "", ""), (1, [0.0, 1.0], 1, 1, "", ""), (2, None, 1, 1, "", ""), (None, [1.0, 1.0], 1, 1, "", "")]
    got = found(ann_tree.nearest(spark.createDataFrame(few, SCHEMA), lambda v: v % 100 == 0))
    assert got == {0: [(pytest.approx(2**0.5), 1)]}
    assert ann_tree.nearest(spark.createDataFrame([], SCHEMA), lambda v: v % 100 == 0).collect() == []


def test_search_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert recall(found(op8_ann_search(spark, sf)), brute_nearest(rows, lambda i: i % 100 == 0)) >= 0.9
