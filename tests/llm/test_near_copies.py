"""The pipeline's near-dedup stage against a brute-force join at 0.8."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from gleaner.llm import shingles


def shingle_sets(text: str) -> set:
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def likeness(a: set, b: set) -> float:
    return len(a & b) / len(a | b)


def edited(rng: random.Random, words: list[str], edits: int) -> str:
    words = list(words)
    for i in rng.sample(range(len(words)), edits):
        words[i] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def planted() -> list[tuple]:
    rng = random.Random(4)
    vocabulary, rows = [f"w{i}" for i in range(5000)], []
    for n in (8, 60, 100, 300, 1000):
        for _ in range(12):
            base = [rng.choice(vocabulary) for _ in range(n)]
            rows.append(" ".join(base))
            rows += [edited(rng, base, k) for k in (1, 1, max(1, n // 60), max(1, n // 45), n // 40, n // 20)]
    chain = [rng.choice(vocabulary) for _ in range(200)]
    rows += [" ".join(chain[k : k + 150]) for k in range(0, 50, 10)]
    rng.shuffle(rows)
    return [(i, t, "x") for i, t in enumerate(rows)]


@pytest.mark.parametrize(("small", "block"), [(shingles.SMALL, shingles.BLOCK), (2, 4)])
def test_groups_equal_brute_force(spark, monkeypatch, small, block):
    """One document of each group stays; groups are those of a full join at 0.8."""
    monkeypatch.setattr(shingles, "SMALL", small)
    monkeypatch.setattr(shingles, "BLOCK", block)
    rows = planted()
    sets = [shingle_sets(t) for _, t, _ in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if group[i] != group[j] and likeness(sets[i], sets[j]) >= 0.8:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert got.columns == docs.columns and {r["doc_id"] for r in got.collect()} == set(group)


def test_spanning_links_equal_brute_force():
    rng = np.random.default_rng(2)
    for sided in (False, True):
        base = [rng.integers(0, 400, 60) for _ in range(6)]
        sets = [np.unique(np.append(base[k % 6][: rng.integers(30, 61)], rng.integers(0, 400, rng.integers(0, 8)))) for k in range(80)]
        component = rng.integers(0, 70, 80)
        side = rng.integers(0, 2, 80) if sided else np.full(80, 2)
        pairs = [(i, j) for i in range(80) for j in range(i) if component[i] != component[j] and (not sided or side[i] != side[j]) and 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))]
        assert pairs

        def groups(edges: list) -> list[int]:
            group = component.tolist()
            for i, j in edges:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
            return [group.index(g) for g in group]

        found = list(zip(*(x.tolist() for x in shingles.spanning(side, component, sets))))
        assert groups(found) == groups(pairs) and all((i, j) in pairs or (j, i) in pairs for i, j in found)


def test_near_copies_with_null_and_repeated_ids(spark):
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(50)) for k in "abcd")
    rows = [(None, a), (None, b), (1, b), (2, c), (2, d), (2, c), (3, d + " end"), (None, None), (None, ""), (9007199254740993, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect() if r["text"]), key=repr)
    assert got == sorted([(None, a), (1, b), (2, c), (2, d), (9007199254740993, "one two")], key=repr)
    assert corpus_pipeline.drop_near_copies(spark, docs, "").where("coalesce(text, '') = ''").count() == 1
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), "").count() == 0


def test_columns_of_any_name_and_type_pass_through(spark):
    """Of the names that the stage uses itself, in any case, and of a type that has no order, with repeated rows."""
    from pyspark.sql import functions as F

    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, text), (1, text), (2, text), (3, "quite another text of some more words than five"), (None, "no id at all but some words here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.concat(F.lit(c), F.col("text")) for c in ("_k1", "_K2", "_doc", "_a", "_b", "_row", "node", "e", "c", "low")} | {"m": F.create_map(F.lit("k"), F.col("text"))})
    found = shingles.keep_one(docs)
    assert found.columns == docs.columns
    got = {r["doc_id"]: r for r in found.collect()}
    assert set(got) == {1, 3, None} and found.count() == 3
    assert all(r[c] == c + r["text"] for r in got.values() for c in ("_k1", "_K2", "_doc", "_a", "_b", "_row", "node", "e", "c", "low")) and all(r["m"] == {"k": r["text"]} for r in got.values())
