"""Searches for many texts, names and items at once, against plain versions on odd rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from itertools import combinations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.operators import keyword_tables, names, page_search, reach, same_items


def plan_of(df, capsys) -> str:
    df.explain()
    return capsys.readouterr().out


# names

VENUES = [(1, "The Red Lion", 1), (2, "red lion", 2), (3, "Red Lion Inn", 2), (4, None, 1), (5, "100% Grape", None), (6, "a_b", 1), (7, "ab", 1), (8, "Üb", 2), (9, "axb", 2), (10, "Red Lion", None), (11, r"back\slash", 1), (12, "", 1)]
WANTED = [
    ("red lion", None), ("red lion", 1), ("red lion", 2), ("RED LION ", 3), ("lion i", None), (" 3", 1), ("99", None), ("9" * 30, None), ("", None), ("  ", 1), (None, 1), ("%", None), ("%", 1), ("___", 2), ("_%_", None),
    ("a_b", None), ("a_b", 2), ("100%", None), ("b", 2), ("üb", None), ("ab", 1), ("zzz", None), ("re%inn", None), ("k\\s", None), ("\\", 1), ("red lion", None), ("d l", 1), ("the%", 1), ("00", None),
]


def like(pattern: str, name: str) -> bool:
    return re.fullmatch("".join({"%": ".*", "_": "."}.get(c, re.escape(c)) for c in pattern.lower()), name.lower(), re.DOTALL) is not None


def plain_resolve(venues, wanted):
    out = {}
    for text, site in set(wanted):
        v = (text or "").strip()
        if v and v.isdigit():
            found = [(0, i) for i, _, _ in venues if i == int(v)]
        else:
            near = [(i, n) for i, n, s in venues if n is not None and (site is None or s == site)]
            found = [(1 if like(v, n) else 2, i) for i, n in near if v and like(f"%{v}%", n)]
        if found:
            out[text, site] = min(found)
    return out


def test_names_resolve_in_bulk(spark, capsys):
    venues, wanted = spark.createDataFrame(VENUES, "id long, name string, site int"), spark.createDataFrame(WANTED, "wanted string, site int")
    found = names.resolve_many(venues, wanted)
    assert {(r["wanted"], r["site"]): (r["tier"], r["id"]) for r in found.collect()} == plain_resolve(VENUES, WANTED)
    assert "NestedLoop" not in plan_of(found, capsys) and "Cartesian" not in plan_of(found, capsys)
    assert names.resolve_many(venues.limit(0), wanted).count() == 0 == names.resolve_many(venues, wanted.limit(0)).count()


def test_a_text_meets_only_names_with_its_rarest_gram(spark):
    index = names.name_index(spark.createDataFrame([("abcd",), ("abcx",), ("ABCD",), ("",), (None,)], "name string"))
    assert sorted(r["name"] for r in index.where("gram = 'bcd'").collect()) == ["abcd"]
    assert {len(r["gram"]) for r in index.collect()} == {1, 2, 3}
    text = spark.createDataFrame([("ab%cde_f",), ("%",)], "t string").select(names.text_grams(F.col("t")).alias("g")).collect()
    assert [sorted(r["g"]) for r in text] == [["ab", "cde", "f"], []]


def test_names_pass_through_no_driver_and_long_texts_meet_few(spark, capsys):
    """no join of resolve_many is broadcast, however small its sides; a long text looks under long grams."""
    venues, wanted = spark.createDataFrame(VENUES, "id long, name string, site int"), spark.createDataFrame(WANTED, "wanted string, site int")
    found = names.resolve_many(venues, wanted)
    found.collect()
    assert "Broadcast" not in plan_of(found, capsys)
    rows = spark.range(2000).select(F.format_string("Customer#%09d", "id").alias("name"))
    (text,) = spark.createDataFrame([("01234",)], "t string").select(names.text_grams(F.col("t")).alias("g")).first()
    assert {names.name_index(rows).where(F.col("gram") == g).count() for g in text} == {1}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text("abAB_%é ", max_size=6), st.sampled_from([None, 1, 2])), min_size=1, max_size=25), st.lists(st.tuples(st.text("abAB_%é", min_size=1, max_size=4), st.sampled_from([None, 1, 2])), min_size=1, max_size=25))
def test_any_names_and_texts(spark, venues, wanted):
    rows = [(k, *v) for k, v in enumerate(venues)]
    found = names.resolve_many(spark.createDataFrame(rows, "id long, name string, site int"), spark.createDataFrame(wanted, "wanted string, site int"))
    assert {(r["wanted"], r["site"]): (r["tier"], r["id"]) for r in found.collect()} == plain_resolve(rows, wanted)


# the same item

ADJECTIVES, NOUNS = "old red grand dry late".split(), "ridge hill chateau estate valley creek".split()


def word_set(name):
    return tuple(sorted(set(re.sub(r"[^a-z0-9]+", " ", re.sub(r"\b(19|20)\d\d\b", " ", name.lower())).split())))


def plain_items(rows, share):
    sets: dict = {}
    for i, name in rows:
        if name is not None:
            sets.setdefault(word_set(name), []).append(i)
    held = Counter(w for s in sets for w in s)
    weight = {w: max(1, math.floor(1000 * math.log((len(sets) + 1) / n))) for w, n in held.items()}
    total = lambda s: sum(weight[w] for w in s)
    links = [(a, b) for a, b in combinations([s for s in sets if s], 2) if 100 * total(set(a) & set(b)) >= share * total(set(a) | set(b))]
    first = {s: s for s in sets}

    def root(s):
        while first[s] != s:
            s = first[s]
        return s

    for a, b in links:
        first[root(a)] = root(b)
    groups: dict = {}
    for s, ids in sets.items():
        if s:
            groups.setdefault(root(s), []).extend(ids)
    out = {i: (0, i) for i, _ in rows}
    for s, ids in sets.items():
        near = [x for a, b in links for x in ((b,) if a == s else (a,) if b == s else ())]
        for i in ids if s else ():
            out[i] = (len(ids) - 1 + sum(len(sets[x]) for x in near), min(groups[root(s)]))
    return out


@pytest.mark.parametrize("share", [50, 70, 95])
def test_items_equal_all_pairs(spark, share, capsys):
    rng = random.Random(share)
    rows = [(k, f"{rng.choice(ADJECTIVES)} {rng.choice(NOUNS).upper()}, {rng.choice(NOUNS)} {rng.choice([1999, 2005, 75])}" + (" reserve" if k % 9 == 0 else "")) for k in range(150)]
    rows += [(900, None), (901, ""), (902, "2001"), (903, "..."), (904, None), (905, rows[0][1]), (906, "Late   Ridge (1990)!"), (907, "ridge LATE"), (908, "word " * 500)]
    found = same_items.same_items(spark.createDataFrame(rows, "id long, name string"), share)
    assert {r["id"]: (r["n_links"], r["item_id"]) for r in found.collect()} == plain_items(rows, share)
    assert "NestedLoop" not in plan_of(found, capsys)


def test_items_of_nothing_and_long_chains(spark):
    assert same_items.same_items(spark.createDataFrame([], "id long, name string")).count() == 0
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["first"] for r in same_items.groups(chain).collect()} == {0}
    with pytest.raises(ValueError, match="share"):
        same_items.alike(None, 100)


def test_items_of_few_words_meet_under_several(spark):
    """names made of few words: under each word stand many names, of which few are alike."""
    rows = [(k, f"{ADJECTIVES[k % 5]} {NOUNS[k // 5 % 6]} maker{k // 30 % 10} size{k // 300 % 20}") for k in range(3000)]
    sets = same_items.weighted_sets(same_items.word_sets(spark.createDataFrame(rows, "id long, name string"))).cache()
    met = {}
    for many in (10, 10**9):
        under = same_items.beginnings(sets, 60, many).groupBy("start", "ended").count()
        met[many] = under.agg(F.sum(F.col("count") * F.col("count"))).first()[0]
    pairs = [{(r["a"], r["b"]): (r["common"], r["all_"]) for r in same_items.alike(sets, 60, many).collect()} for many in (10, 10**9)]
    assert pairs[0] == pairs[1] and len(pairs[0]) == 13_500
    assert 10 * met[10] < met[10**9], met


# pages that sites reach


def test_reached_pages_equal_a_plain_search(spark):
    rng = random.Random(1)
    links = [(f"p{rng.randrange(40)}", f"p{rng.randrange(40)}") for _ in range(70)] + [("p1", "p1"), ("p1", None), (None, "p2"), ("p3", "p4"), ("p3", "p4")]
    starts = [("a", "p1"), ("a", "p1"), ("a", "p9"), ("b", "p1"), ("c", "nowhere"), (None, "p1"), ("d", None)]
    want = {}
    for site in "abc":
        front = {p for s, p in starts if s == site}
        for step in range(4):
            front = {p for p in front if (site, p) not in want}
            want |= {(site, p): step for p in front}
            front = {d for s, d in links if s in front and d is not None and d != s}
    frames = spark.createDataFrame(links, "src string, dst string"), spark.createDataFrame(starts, "site string, page string")
    found = reach.reachable(*frames, steps=3)
    rows = [(r["site"], r["page"], r["step"]) for r in found.collect()]
    assert {(s, p): k for s, p, k in rows} == want and len(rows) == len(want)
    assert reach.reachable(frames[0], frames[1].limit(0)).count() == 0
    assert {r["step"] for r in reach.reachable(frames[0].limit(0), frames[1]).collect()} == {0}


def test_pages_are_parsed_once_and_give_their_own_links(spark):
    html = '<a href="/b/">b</a><a href="/b">b</a><a href="https://other.org/c">c</a><a href="/login">no</a><a>none</a>'
    pages = spark.createDataFrame([("https://x.org/a?q", html), ("https://x.org/b", ""), ("https://x.org/c", None)], "url string, html string")
    assert [tuple(r) for r in reach.page_links(pages).collect()] == [("https://x.org/a", "https://x.org/b")]


# search over pages

PAGES = [(1, "red wine bar"), (2, "red red wine"), (3, "wine list pdf red"), (4, None), (5, ""), (6, "Bar & Grill, été"), (7, "été été wine"), (8, "red wine bar")]


def plain_answers(pages, queries, first):
    words = {p: re.findall(r"[^\W_]+", (t or "").lower()) for p, t in pages}
    words = {p: w for p, w in words.items() if w}
    total, df = sum(map(len, words.values())), Counter(x for w in words.values() for x in set(w))
    out = {}
    for q, text in queries:
        asked = set(re.findall(r"[^\W_]+", (text or "").lower()))
        scored = []
        for p, w in words.items():
            if asked and asked <= set(w):
                part = lambda x: (2200000 * w.count(x)) // (1000 * w.count(x) + 300 + (900 * len(w) * len(words)) // total)  # noqa: B023, E731
                scored.append((-sum(math.floor(1000 * math.log((2 * len(words) + 2) / (2 * df[x] + 1))) * part(x) for x in asked), p))
        out[q] = [(p, -s, k) for k, (s, p) in enumerate(sorted(scored)[:first], 1)]
    return {q: x for q, x in out.items() if x}


@pytest.mark.parametrize("first", [1, 5])
def test_answers_equal_plain_scores(spark, first):
    index = page_search.page_index(spark.createDataFrame(PAGES, "page long, text string")).cache()
    queries = [("a", "red wine"), ("b", "WINE"), ("c", "wine nowhere"), ("d", None), ("e", "&"), ("f", "été"), ("g", "bar wine red"), ("h", "red red")]
    found = page_search.answers(index, spark.createDataFrame([*queries, queries[0]], "query string, text string"), first)
    got: dict = {}
    for r in found.orderBy("query", "rank").collect():
        got.setdefault(r["query"], []).append((r["page"], r["score"], r["rank"]))
    assert got == plain_answers(PAGES, queries, first)
    assert page_search.answers(index.limit(0), spark.createDataFrame(queries, "query string, text string")).count() == 0


def test_a_page_that_meets_a_query_is_one_row(spark, capsys):
    """neither the words of a query nor its forms multiply the rows that are shuffled: one Generate for each table."""
    index = page_search.page_index(spark.createDataFrame(PAGES, "page long, text string")).cache()
    queries = [(str(k), t) for k, t in enumerate(["red wine bar", "bar & wine red", "BAR RED WINE", "Wine bar, red wine"])]
    found = page_search.answers(index, spark.createDataFrame(queries, "query string, text string"))
    rows = {}
    for r in found.collect():
        rows.setdefault(r["query"], []).append((r["rank"], r["page"], r["score"]))
    assert len(rows) == 4 and len({tuple(sorted(x)) for x in rows.values()}) == 1
    assert "_asked" not in "".join(x for x in plan_of(found, capsys).splitlines() if "Generate" in x)


def rows_moved(df) -> int:
    """Rows written by all shuffles of ``df``, which is run."""
    df.collect()
    found, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "ShuffleExchangeExec":
            found += node.metrics().apply("shuffleRecordsWritten").value()
        inner = [node.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [node.plan()] if kind.endswith("QueryStageExec") else []
        nodes += inner + [node.children().apply(k) for k in range(node.children().size())]
    return found


def test_pages_that_meet_queries_are_not_moved(spark):
    """40 queries that each meet all of 4000 pages: what is moved grows with the pages and the queries, not with their product."""
    text = F.concat_ws(" ", *(F.when(F.col("id") % (k + 2) == 0, f"w{k} w{k}").otherwise(f"w{k}") for k in range(20)))
    index = page_search.page_index(spark.range(4000).select(F.col("id").alias("page"), text.alias("text"))).cache()
    queries = spark.createDataFrame([(f"{a} {b}", f"w{a} w{b}") for a in range(20) for b in (a, (a + 7) % 20)], "query string, text string")
    found = page_search.answers(index, queries)
    assert rows_moved(found) < 20_000 < 40 * 4000
    assert {tuple(r) for r in found.groupBy("rank").count().collect()} == {(k, 40) for k in range(1, 6)}


@pytest.mark.parametrize(("block", "most"), [(1, 1), (20, 3), (10**9, 10**9)])
def test_answers_do_not_depend_on_blocks(spark, block, most):
    """F1: equal scores and answers, however few pages and queries meet at once."""
    rng = random.Random(block)
    pages = [(p, " ".join(rng.choices(["red", "wine", "été", "bar", "list"], [9, 5, 3, 2, 1], k=rng.randrange(12))).title()) for p in range(60)]
    queries = [(f"{a}{k}", f"{a}, {b}") for a in ["red", "wine", "été", "bar", "list"] for k, b in enumerate(["red", "wine", "BAR", "nowhere", ""])]
    index = page_search.page_index(spark.createDataFrame(pages, "page long, text string")).cache()
    got: dict = {}
    for r in page_search.answers(index, spark.createDataFrame(queries, "query string, text string"), 3, block, most).orderBy("query", "rank").collect():
        got.setdefault(r["query"], []).append((r["page"], r["score"], r["rank"]))
    assert got == plain_answers(pages, queries, 3) and len(got) == 20


def test_rows_of_one_page_are_one_page(spark):
    """Its words are those of all its rows; a page without an id counts and answers nothing."""
    rows = [(1, "red wine"), (2, "red"), (1, "Bar red"), (None, "zebra red"), (3, "wine red bar red"), (None, "zebra")]
    index = page_search.page_index(spark.createDataFrame(rows, "page long, text string")).cache()
    queries = [("a", "red"), ("b", "wine bar"), ("c", "zebra")]
    want = plain_answers([(1, "red wine bar red"), (2, "red"), (3, "wine red bar red"), (99, "zebra red zebra")], queries, 5)
    want = {q: [(p, s, k) for k, (p, s) in enumerate([(p, s) for p, s, _ in x if p != 99], 1)] for q, x in want.items() if q != "c"}
    got: dict = {}
    for r in page_search.answers(index, spark.createDataFrame(queries, "query string, text string")).orderBy("query", "rank").collect():
        got.setdefault(r["query"], []).append((r["page"], r["score"], r["rank"]))
    assert got == want


def test_lists_are_found_in_two_passes(spark):
    head = lambda name: f"<title>{name}</title><h1>Menu</h1>"
    hub = "https://hub.binwise.com/list/"
    pages = [(1, hub + "1?x=2", head("Blue Door") + "pdf"), (2, hub + "2", head("Blue Door")), (3, "https://else.org/3", head("Green Room") + "pdf"), (4, hub + "4", head("Green Room")), (5, hub + "5", head("Blue Moon") + "door pdf"), (6, hub + "6", None)]
    frame = spark.createDataFrame(pages, "page long, url string, html string")
    index = page_search.page_index(frame.select("page", page_search.visible(F.col("html")).alias("text"))).cache()
    venues = [(1, "Blue Door"), (2, "Green Room"), (3, "Nowhere"), (4, None), (5, " "), (6, "Blue Door"), (7, "door blue")]
    found = page_search.find_lists(frame, index, spark.createDataFrame(venues, "id long, name string"))
    assert {r["id"]: r["url"] for r in found.collect()} == {1: hub + "1", 2: hub + "4", 3: None, 4: None, 5: None, 6: hub + "1", 7: None}


# phrases


@pytest.mark.parametrize("characters", [20_000_000, 6])
def test_phrases_equal_plain_search(spark, characters):
    texts = [(1, "abababa"), (2, None), (3, ""), (4, "the cellar\nlist"), (5, "été 日本"), (5, "été"), (6, "x" * 100_000 + "end")]
    phrases = ["aba", "ab", "b", "cellar\nlist", "日", "été", "end", "nothing", "", None, "ab"]
    df, table = spark.createDataFrame(texts, "id long, text string"), spark.createDataFrame([(p,) for p in phrases], "phrase string")
    found = keyword_tables.phrases_in(df, table, characters)
    want = Counter()
    for i, t in texts:
        for p in {p for p in phrases if p}:
            if times := sum((t or "").startswith(p, k) for k in range(len(t or ""))):
                want[i, p, times] += 1
    assert Counter((r["id"], r["phrase"], r["times"]) for r in found.collect()) == want
    counts = {r["phrase"]: (r["texts"], r["times"]) for r in keyword_tables.phrase_counts(df, table, characters).collect()}
    assert counts["été"] == (2, 2) and counts["nothing"] == (0, 0) and counts["aba"] == (1, 3) and len(counts) == 8
    assert keyword_tables.phrases_in(df, table.limit(0)).count() == 0 == keyword_tables.phrases_in(df.limit(0), table).count()
