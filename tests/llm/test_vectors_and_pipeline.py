"""Embedding near-dedup, connected components and the pipeline."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gleaner.llm import common, covertree
from gleaner.llm.common import components


def brute(rows: list[tuple], cosine: float) -> dict[int, tuple[int, int]]:
    def fine(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n, group = [0] * len(rows), list(range(len(rows)))
    for i, (_, v, a) in enumerate(rows):
        for j, (_, w, b) in enumerate(rows[:i]):
            if a is not None and a == b and fine(v) and fine(w) and len(v) == len(w):
                if np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= cosine:
                    n[i] += 1
                    n[j] += 1
                    old, new = max(group[i], group[j]), min(group[i], group[j])
                    group = [new if g == old else g for g in group]
    low = {g: min(rows[i][0] for i in range(len(rows)) if group[i] == g) for g in set(group)}
    return {r[0]: (n[i], low[group[i]]) for i, r in enumerate(rows)}


def vectors() -> list[tuple]:
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(12, 8))
    rows = [(i, [float(np.float32(x)) for x in centers[i % 12] + rng.normal(size=8) * 0.12], i % 2) for i in range(240)]
    rows += [(300 + i, rows[5][1], 1) for i in range(6)] + [(320, [2 * x for x in rows[5][1]], 1)]
    return rows + [(400, None, 1), (401, [], 1), (402, [0.0] * 8, 1), (403, [float("nan")] * 8, 1), (404, [None] * 8, 1), (405, rows[5][1], None), (406, [1.0, 0.0], 1), (407, [1.0, 0.001], 1)]


@pytest.mark.parametrize(("block", "leaf", "pivots", "saves"), [(2000, 16, 64, 0.7), (20, 4, 3, 10.0), (30, 1, 4, 0.0)])
def test_links_and_components_equal_brute_force(spark, monkeypatch, block, leaf, pivots, saves):
    rows = vectors()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, extra string")
    for name, value in (("BLOCK_ROWS", block), ("LEAF", leaf), ("PIVOTS", pivots), ("SAVES", saves)):
        monkeypatch.setattr(covertree, name, value)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in covertree.near_duplicates(df).collect()}
    assert got == brute(rows, covertree.COSINE)


def test_clustered_cells_are_split_and_random_ones_are_not(spark, monkeypatch):
    monkeypatch.setattr(covertree, "BLOCK_ROWS", 50)
    monkeypatch.setattr(covertree, "MOVED", 10)
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(20, 16)) * 5
    tight = [(i, 1, [float(x) for x in centers[i % 20] + rng.normal(size=16) * 0.2]) for i in range(400)]
    loose = [(1000 + i, 2, [float(x) for x in rng.normal(size=16)]) for i in range(200)]
    reps = spark.createDataFrame([(i, k, 16, v, 1) for i, k, v in tight + loose], "rep long, label int, dim int, v array<double>, copies long")
    found = covertree.cells(reps, 0.374).groupBy("label").agg(F.countDistinct("cell").alias("cells"), F.count(F.lit(1)).alias("rows"), F.count_if("home").alias("homes")).orderBy("label").collect()
    assert [r["homes"] for r in found] == [400, 200] and found[0]["cells"] >= 8 and found[0]["rows"] < 800 and (found[1]["cells"], found[1]["rows"]) == (1, 200)


def test_no_vectors(spark):
    assert covertree.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_trees_prune_and_equal_all_pairs():
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(40, 24))
    x = covertree.unit(np.concatenate([c + rng.normal(size=(12, 24)) * rng.choice([0.02, 0.2, 0.3]) for c in centers]))
    w = rng.integers(1, 5, len(x))
    for y in (None, covertree.unit(np.concatenate([x[:100] + rng.normal(size=(100, 24)) * 0.03, rng.normal(size=(60, 24))]))):
        wy = w if y is None else rng.integers(1, 5, len(y))
        seen = Counter()
        nx, ny, a, b = covertree.dual_links(x, y, w, wy, 0.93, seen)
        hit = x @ (x if y is None else y).T >= 0.93
        if y is None:
            np.fill_diagonal(hit, False)
        assert (nx == hit @ wy).all() and (y is None or (ny == hit.T @ w).all()) and hit[a, b].all()
        group = lambda p, q: components_of(len(x), len(x) if y is None else len(y), p, q, y is None)
        assert group(a, b) == group(*np.nonzero(hit))
        assert seen["rows"] < (0.25 if y is None else 0.5) * hit.size and seen["pruned"] > 0 and seen["opened"] > 0 and (y is not None or seen["whole"] > 0)


def components_of(n: int, m: int, a, b, same: bool) -> list[int]:
    parent = list(range(n if same else n + m))

    def find(v: int) -> int:
        while parent[v] != v:
            v = parent[v]
        return v

    for i, j in zip(a.tolist(), b.tolist()):
        u, v = find(i), find(j if same else n + j)
        parent[max(u, v)] = min(u, v)
    return [find(v) for v in range(len(parent))]


def test_cover_tree_levels():
    rng = np.random.default_rng(6)
    x = covertree.unit(rng.normal(size=(300, 6)))
    todo, nodes = [covertree.cover_tree(x, 4)], 0
    while todo:
        node = todo.pop()
        nodes += 1
        assert (covertree.chord(x[node.rows] @ x[node.center]) <= node.radius + 1e-12).all()
        if len(node.centers):
            singles = [c for k, c in enumerate(node.centers) if k not in node.nodes]
            assert sorted([*singles, *(r for n in node.nodes.values() for r in n.rows.tolist())]) == sorted(node.rows.tolist())
            assert (node.radii <= node.radius).all() and node.center in node.centers and all(node.radii[k] == n.radius and node.centers[k] == n.center for k, n in node.nodes.items())
        todo += node.nodes.values()
    assert nodes > 20


@pytest.mark.parametrize("hot", [200_000, 0])
def test_hot_keys_and_hubs(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    monkeypatch.setattr(common, "HOT", 3)
    rows = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 60 + [2] * 5 + list(range(3, 20)))], "k long, i long")
    keyed = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("x", F.col("k") * 2)
    assert sorted((r["k"], r["i"], r["x"]) for r in common.join_hot(rows, keyed, ["k"], "n").collect()) == sorted((r["k"], r["i"], 2 * r["k"]) for r in rows.collect())
    edges = [(0, k) for k in range(1, 80)] + [(200, 201), (201, 202)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(80)} | {200: 200, 201: 200, 202: 200}


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 50)] + [(200 + rng.randrange(30), 200 + rng.randrange(30)) for _ in range(25)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    group = {x: x for e in edges for x in e}
    for _ in range(80):
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    assert got == {x: g for x, g in group.items() if any(x in e and e[0] != e[1] for e in edges)}


def test_pipeline_keeps_clean_documents_and_packs_all(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns and out.count() > 0.6 * docs.count()
        docs = out
    packed = corpus_pipeline.run(spark, "/root/testdata/sf0.001").toPandas()
    first = packed.drop_duplicates("doc_id")
    assert packed["length"].sum() == first["doc_tokens"].sum() and set(first["doc_id"]) == {r[0] for r in docs.select("doc_id").collect()}
