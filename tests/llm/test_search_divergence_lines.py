"""op11-op13: their SQL on the whole small tables, and plain versions on odd rows."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import chain

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.llm import divergence, lines, queries, search
from tests.compare import duck, same

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_equals_its_sql(spark, name):
    equal, what = same(queries.QUERIES[name](spark, FOLDER), queries.ORACLE_SQL[name], duck(FOLDER))
    assert equal, what


# --- op11

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(docs, items, k):
    words = [WORDS.findall((text or "").translate(LOWER)) for _, text in docs]
    n, total = sum(map(bool, words)), sum(map(len, words))
    df = Counter(chain.from_iterable(map(set, words)))
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in items:
        found = []
        for (doc, _), own in zip(docs, words, strict=True):
            tf, m = Counter(own), 100 - 50 + ((50 * len(own) * n) // max(total, 1))
            score = sum(weight[t] * ((1000000000 * tf[t]) // (1000 * tf[t] + 20 * m)) for t in set(WORDS.findall((text or "").translate(LOWER))) if tf[t])
            if score > 0:
                found.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(found, key=lambda x: (*x[:2], x[2] or 0))[:k], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=repr)


DOCS = [
    (1, "Red wine, red WINE; blue"), (2, None), (3, ""), (4, "Été été ÉTÉ 12x"), (5, "red"), (5, "red"), (None, "red wine"), (7, "... !!"), (8, "blue " * 3000 + "wine"),
    (9, "white wine and red"), (10, "wine"), (11, "and and and"), (12, "12x blue"), (13, "blue red"), (None, "red wine"), (14, "red wine blue white and 12x été"),
]
ITEMS = [(1, "RED wine"), (2, None), (3, "nothing here"), (4, "été 12X blue and white wine red"), (4, "blue"), (None, "and"), (6, "")]


@pytest.mark.parametrize(("k", "block", "terms"), [(3, 4, 1000), (2, 1, 3), (50, 8192, 1000), (1, 2, 5)])
def test_search_equals_plain_scores(spark, k, block, terms):
    docs = spark.createDataFrame([(*r, 0.5) for r in DOCS], "doc_id long, text string, score double").repartition(3)
    found = search.search(docs, spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, rank string"), k, block, terms)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_search(DOCS, ITEMS, k)


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert search.search(none, items).count() == 0
    assert search.search(spark.createDataFrame(DOCS, "doc_id long, text string"), items.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), max_size=9), min_size=1, max_size=12), st.lists(st.integers(0, 6), max_size=7, unique=True), st.integers(1, 4))
def test_bounds_hold_and_skips_lose_nothing(docs, asked, k):
    """Of every beginning of a path no document gets more than its bound; the found ones hold the first k."""
    weights = np.array([700, 10, 300, 0, 450, 90, 2000])
    counts = [Counter(x) for x in docs]
    ends = np.cumsum([0, *map(len, counts)])
    flat = [np.array(list(chain.from_iterable(getattr(c, f)() for c in counts)), np.int64) for f in ("keys", "values")]
    ordered, sides, pairs = search.paths([asked], weights)
    lengths = np.array([len(x) for x in docs])
    block = search.Block(lengths, ends, flat[0], flat[1], weights, len(docs), int(lengths.sum()), pairs)
    impact = lambda t, d: int(weights[t]) * ((10**9 * counts[d][t]) // (1000 * counts[d][t] + 20 * (50 + 50 * len(docs) * len(docs[d]) // max(int(lengths.sum()), 1)))) if counts[d][t] else 0
    path = ordered[0].tolist()
    for i, bound in enumerate(block.bounds(ordered[0], sides[0])):
        assert all(sum(impact(t, d) for t in path[:i]) <= bound for d in range(len(docs)))
    true = sorted(((sum(impact(t, d) for t in path), -d) for d in range(len(docs))), reverse=True)
    found, scores = block.search(ordered[0], sides[0], 0, k)
    got = dict(zip(found.tolist(), scores.tolist(), strict=True))
    assert all(got[-d] == score for score, d in true[:k] if score > 0)


def test_pairs_tighten_the_bound():
    """Two terms that never meet give no more than the larger of the two."""
    weights = np.array([100, 200])
    ordered, sides, pairs = search.paths([[0, 1]], weights)
    apart = search.Block(np.array([1, 1]), np.array([0, 1, 2]), np.array([0, 1]), np.array([1, 1]), weights, 2, 2, pairs)
    assert apart.bounds(ordered[0], sides[0])[-1] == apart.tops.max() < apart.tops.sum()


# --- op12

LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_divergence(docs, least, top):
    found, groups = defaultdict(Counter), defaultdict(lambda: defaultdict(Counter))
    for lang, source, text in docs:
        terms = LETTERS.findall((text or "").translate(LOWER))
        groups[lang or ""][source or ""].update(terms)
        found[lang or ""].update(set(terms))
    out = []
    for lang, by in groups.items():
        kept = sorted(t for t, n in found[lang].items() if n >= least)
        p_of = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[x] for x in kept) + 2 * len(kept)) for t in kept}  # noqa: E731, B023
        f = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: p_of(c) for s, c in by.items()}, p_of(sum(by.values(), Counter()))
        for source, counts in by.items():
            parts = {"pair": [(sum(f(p[source][t], p[x][t]) for t in kept), x) for x in by if x != source], "term": [(f(p[source][t], q[t]), t) for t in kept if counts[t] and p[source][t] > q[t]]}
            for part, values in parts.items():
                ranked = sorted(values, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, source, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1) if part == "pair" or rank <= top]
    return sorted(out, key=repr)


MIXED = (
    [("en", f"s{k % 4}", f"wine {'red ' * (k % 5)}list{k % 3} Été {k} the{k}the" + " rosé" * (k % 2)) for k in range(60)]
    + [("fr", "s0", "vin rouge"), ("fr", "s0", "vin rouge"), ("fr", "s1", None), ("fr", None, "vin blanc"), (None, None, "wine"), (None, "s1", ""), ("de", "x", "1 2 3"), ("de", "y", "Wein"), ("", "s1", "wine wine")]
)


@pytest.mark.parametrize(("least", "top", "cells", "held", "most"), [(2, 3, 4_000_000, 300_000, 100), (1, 1, 4, 5, 3), (3, 10, 9, 1, 6)])
def test_divergence_equals_plain_sums(spark, monkeypatch, least, top, cells, held, most):
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "HELD", held)
    docs = spark.createDataFrame([(*r, 1) for r in MIXED], "lang string, source string, text string, value int").repartition(5)
    found = divergence.divergence(docs, least, top, most)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_divergence(MIXED, least, top)


def test_divergence_of_nothing_and_of_too_many_groups(spark):
    assert divergence.divergence(spark.createDataFrame([], "lang string, source string, text string")).count() == 0
    many = spark.range(9).select(F.lit("en").alias("lang"), F.col("id").cast("string").alias("source"), F.lit("a").alias("text"))
    with pytest.raises(ValueError, match="sources"):
        divergence.divergence(many, 1, 10, 2)


@given(st.integers(0, 10**15), st.integers(0, 10**15), st.integers(1, 10**6))
def test_shares_are_exact(count, more, v):
    whole = count + more + 2 * v
    assert divergence.shares(np.array([count]), np.array([whole]))[0] == 1 + 10**9 * (count + 2) // whole


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=40))
def test_runs_give_the_sum_over_terms(rows):
    counts = np.array(rows)
    wholes = counts.sum(axis=0) + 2 * len(rows)
    p = [divergence.shares(counts[:, k], wholes[k]) for k in range(3)]
    slice_ = divergence.Slice(counts, wholes)
    assert all(slice_.pair(a, b) == divergence.apart(p[a], p[b]).sum() for a in range(3) for b in range(3))


# --- op13

LINE = "A line of text that is long enough"
TEXTS = [
    (1, f"{LINE}\nshort\n  {LINE.upper()}\t\nown one"), (2, f"{LINE}\n\n"), (3, f"x\n{LINE}"), (9, f"{LINE}\n{LINE}"), (4, None), (5, ""), (6, "\n\n"), (7, "short\nshort"),
    (None, f"{LINE}\nonly rows without an id hold this line"), (None, "only rows without an id hold this line"), (None, "only rows without an id hold this line"),
    (8, "É" * 20 + "\nte"), (10, " " + "É" * 20), (11, "é" * 20), (12, "É" * 20 + "\v"), (13, "É" * 19), (14, "É" * 19), (15, "É" * 19),
    (16, "two rows share this id and line"), (16, "two rows share this id and line\nmore"), (17, "two rows share this id and line"), (17, "two rows share this id and line"),
    (18, "held by two documents only, so it stays"), (19, "held by two documents only, so it stays"), (20, "long " * 20000 + "\n" + LINE),
]


def plain_lines(docs, least=3):
    key = lambda line: line.strip(" \t\n\v\f\r").translate(LOWER)
    held = defaultdict(list)
    for doc, text in docs:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 20:
                held[k].append(doc)
    last = {k: max((x for x in v if x is not None), default=None) for k, v in held.items() if len(v) >= least}
    out = []
    for doc, text in docs:
        rows = (text or "").split("\n")
        kept = [x for x in rows if key(x) not in last or last[key(x)] == doc]
        out.append((doc, len(rows), len(rows) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches", [1, 3, 8])
def test_lines_equal_a_plain_version(spark, batches):
    docs = spark.createDataFrame([(*r, len((r[1] or "").split("\n"))) for r in TEXTS], "doc_id long, text string, _row int").repartition(3)
    found = lines.deduplicate(docs, batches)
    assert found.columns == ["doc_id", "text", "_row", "n_dropped"]
    rows = [(r["doc_id"], r["_row"], r["n_dropped"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in found.collect()]
    assert sorted(rows, key=repr) == plain_lines(TEXTS)
    assert found.where("doc_id = 4").first()["text"] is None


def test_lines_of_nothing(spark):
    assert lines.deduplicate(spark.createDataFrame([], "doc_id long, text string, n_dropped string")).columns == ["doc_id", "text", "n_dropped_aside", "n_dropped"]
    assert lines.deduplicate(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_runs_take_batches_in_any_order(spark, tmp_path):
    """Counts and largest ids are those of all batches; settled entries are not written again; a level holds one run."""
    batches = [[(h, 2 * h + 1, d) for h in range(5) for d in range(b, b + h)] for b in (5, 50, 1, 20, 30)]
    store = lines.Runs(spark, str(tmp_path), 3)
    entry = lambda rows: lines.entries(spark.createDataFrame(rows, "h1 long, h2 long, doc_id long"))
    for rows in batches:
        store.add(entry(rows))
    assert [bool(x) for x in store.levels] == [True, False, True]
    oldest = spark.table(store.levels[2]).where("h1 = 4").first()
    store.add(entry([(4, 9, 40), (0, 1, 7)]))
    assert [r["h1"] for r in spark.table(store.levels[1]).where("h1 IN (0, 4) AND last IN (7, 40)").collect()] == [0]  # 50 settled the other
    every = [x for rows in batches for x in rows]
    got = {r["h1"]: (r["n"], r["last"]) for r in store.totals().collect()}
    want = {h: max(d for x, _, d in every if x == h) for h in range(1, 5)}
    assert oldest["last"] == 53 and {h: last for h, (_, last) in got.items()} == want and all(n >= 3 for n, _ in got.values())
    assert not [t.name for t in spark.catalog.listTables() if t.name != store.levels[0] and t.name.startswith(store.name)]
    store.forget()
