"""op9's scores against one trie of all contexts, however few are broadcast."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import ppm


@pytest.mark.parametrize(("contexts", "order", "table_rows"), [(20, 5, 1_000_000), (20, 5, 50), (2_000_000, 5, 1_000_000), (20, 2, 1_000_000)])
def test_scores_use_every_context(spark, monkeypatch, contexts, order, table_rows):
    monkeypatch.setattr(ppm, "TABLE_ROWS", table_rows)
    rng = random.Random(5)
    words = "the of and naïve thing other reed 東京 whble onion tibles".split()
    rows = [(i, " ".join(rng.choice(words) + rng.choice(["", "s", "x"]) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    rows += [(None, "no id"), (3, "a text of its own"), (8, None), (9, "zzz qqq")]
    learned = [t for i, t in rows if (1 if i is None else i) % 4 != 0]
    top, n = np.unique(ppm.grams_of(learned, order)[0], return_counts=True)
    grams, counts = [], []
    for k in range(order + 1):
        u, back = np.unique(top & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
        grams.append(u | k << 56)
        counts.append(np.bincount(back, weights=n).astype(np.int64))
    trie = ppm.Trie(np.concatenate(grams), np.concatenate(counts), order)
    want = sorted((repr(i), round(float(trie.log10(ppm.grams_of([t], order)[0]).sum()), 6)) for i, t in rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(ppm, "CONTEXTS", contexts)
    got = ppm.score(docs, F.coalesce(F.col("doc_id"), F.lit(1)) % 4 != 0, order, contexts)
    assert sorted((repr(r["doc_id"]), round(r["score"], 6)) for r in got.collect()) == want


def plain_scores(learned: list, texts: list, order: int) -> list[float]:
    """Prediction by partial matching by dictionaries: a byte's count less a half over the counts that no longer context
    has excluded, or an escape of a half for each such byte; at last all bytes that are left are equally likely."""
    line = lambda t: b"\n" * order + b" ".join((t or "").encode().lower().split()) + b"\n"
    counts: dict = defaultdict(Counter)
    for t in learned:
        b = line(t)
        for i in range(order, len(b)):
            for k in range(order + 1):
                counts[b[i - k : i]][b[i]] += 1
    out = []
    for t in texts:
        b, total = line(t), 0.0
        for i in range(order, len(b)):
            excluded: set = set()
            for k in range(order, -1, -1):
                seen = counts.get(b[i - k : i])
                if seen is None:
                    continue
                left = {x: n for x, n in seen.items() if x not in excluded}
                if b[i] in left:
                    total += math.log10((left[b[i]] - 0.5) / sum(left.values()))
                    break
                if left:
                    total += math.log10(0.5 * len(left) / sum(left.values()))
                excluded = set(seen)
            else:
                total -= math.log10(256 - len(excluded))
        out.append(total)
    return out


@pytest.mark.parametrize("order", [5, 1])
def test_scores_are_those_of_a_plain_model(spark, order):
    """On whole texts of the given tables, odd ones among them, by a model that shares no code with the operator's."""
    rows = [(r["doc_id"], r["text"][:1500]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect()]
    rows += [(None, "no id"), (1001, None), (1002, ""), (1003, "zzz qqq 日本"), (1003, "the the the")]
    learned = [t for i, t in rows if (1 if i is None else i) % 4 != 0]
    got = ppm.score(spark.createDataFrame(rows, "doc_id long, text string"), F.coalesce(F.col("doc_id"), F.lit(1)) % 4 != 0, order).collect()
    want = plain_scores(learned, [t for _, t in rows], order)
    assert sorted((repr(r["doc_id"]), round(r["score"], 5)) for r in got) == sorted((repr(i), round(s, 5)) for (i, _), s in zip(rows, want, strict=True))


def test_grams_are_moved_once(spark):
    """What is asked goes to the counts and comes back as sums: no distinct grams are moved besides, and none of the
    answers is joined back by gram."""
    asked = spark.createDataFrame([(r, g, 1 + r % 2) for r in range(30) for g in (0x616263646566, 0x616263646567)], "row long, gram long, k int")
    top = spark.createDataFrame([(0x616263646566, 3), (0x7A6263646567, 2)], "gram long, n long")
    keys, n = np.array([0x616263646566, 0x7A6263646567]), np.array([3, 2])
    grams, counts = [], []
    for k in range(6):
        u, back = np.unique(keys & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
        grams.append(u | k << 56)
        counts.append(np.bincount(back, weights=n).astype(np.int64))
    trie = ppm.Trie(np.concatenate(grams), np.concatenate(counts))
    p = trie.log10(keys[:1])[0] + trie.log10(np.array([0x616263646567]))[0]
    found = ppm.decide(top, asked, spark.sparkContext.broadcast(trie)).groupBy("row").agg(F.sum("p").alias("p"))
    assert {r["row"]: round(r["p"], 9) for r in found.collect()} == {r: round((1 + r % 2) * p, 9) for r in range(30)}
    docs = spark.createDataFrame([(i, f"text {i} of some words") for i in range(20)], "doc_id long, text string")
    plan = ppm.score(docs, F.col("doc_id") % 4 != 0, 5, 20)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 3 and plan.count("Aggregate") == 2  # words, and the sums of words and of grams by row
