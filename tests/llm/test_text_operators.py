"""The text operators against brute force, exact round trips and edge cases."""

from __future__ import annotations

import hashlib
import itertools
import json
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gleaner.llm import bytepair, chat, chunks, fingerprints, language, packing, ppm, simhash, wrappers
from gleaner.llm.common import ordered_buckets

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"
WORDS = "the of and in to thing other reed anlyst over whble hea erth onion tibles".split()


def prose(rng: random.Random, n: int) -> str:
    return "".join(rng.choice(WORDS) + rng.choice(["", rng.choice(WORDS)]) + rng.choice([" ", " ", " ", ". ", ".\n"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(40)]
    texts += [None, "", " \n\t ", texts[0], texts[0], texts[1] + " more", "é" * 3000, "word " * 4000]
    found = [(i, t, "en", None if i % 11 == 0 else f"s{i % 3}", None if t is None else len(t), "x") for i, t in enumerate(texts)]
    return [*found, found[3], (None, "no id here", None, "s1", 10, None), (7, "same id, other text", "en", "s1", 19, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# op1


def test_fingerprints_pair_each_row_with_the_next(spark):
    rng = random.Random(5)
    texts = {i * 37: prose(rng, rng.randint(1, 60)) for i in range(300)}
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_documents(spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")).collect()}
    ids = sorted(texts, reverse=True)
    assert set(got) == set(ids)
    for i, nxt in zip(ids, ids[1:] + ids[:1]):
        t, h = texts[i], len(texts[i]) // 2
        assert got[i]["edited_text"] == t[: len(t) - h] + texts[nxt][:h]


def test_fingerprints_edge_rows(docs, none, rows):
    found = fingerprints.fingerprint_documents(docs).collect()
    assert len(found) == len(rows) and fingerprints.fingerprint_documents(none).count() == 0
    same = [r["vector"] for r in found if r["doc_id"] in (0, 43, 44)]
    assert same[0] == same[1] == same[2]


def test_fingerprints_are_homomorphic(spark):
    df = spark.createDataFrame([("a\nb\nc", "c\na\nb", "a\nb", "c")], "x string, y string, z string, w string")
    f = lambda c: fingerprints.fingerprint(F.col(c))
    drop = lambda v: F.slice(v, 1, F.size(v) - 1)
    r = df.select(f("x").alias("vx"), f("y").alias("vy"), drop(f("x")).alias("v"), fingerprints.add(drop(f("z")), drop(f("w"))).alias("s"), drop(f("z")).alias("vz"), fingerprints.subtract(drop(f("x")), drop(f("w"))).alias("d"), fingerprints.likeness(f("x"), f("y")).alias("n"), fingerprints.likeness(f("x"), f("w")).alias("m")).first()
    assert r["vx"] == r["vy"] and r["v"] == r["s"] and r["d"] == r["vz"] and r["n"] == 1.0 and 0.3 < r["m"] < 0.85


@pytest.mark.parametrize("times", [5_000, 1_000_000])
def test_likeness_of_repeated_lines(spark, times):
    """A line as often as one likes: half of the same lines is the same direction, other lines are another. The sums of the
    repeated lines are those of one line, doubled and added up."""

    def repeated(line: str, n: int) -> list[int]:
        one = spark.createDataFrame([(line,)], "t string").select(fingerprints.fingerprint(F.col("t")).alias("v")).first()["v"]
        lanes = [[(x >> f) & fingerprints.LANE for f in fingerprints.FIELDS] for x in one[:-1]]
        return [sum((x * n & fingerprints.LANE) << f for x, f in zip(pair, fingerprints.FIELDS, strict=True)) for pair in lanes] + [n]

    rows = [(repeated("same line", times), repeated("same line", times // 2), repeated("other", times))]
    df = spark.createDataFrame(rows, "x array<long>, y array<long>, z array<long>")
    r = df.select(fingerprints.likeness(F.col("x"), F.col("y")).alias("half"), fingerprints.likeness(F.col("x"), F.col("z")).alias("other")).first()
    assert r["half"] > 0.999 and r["other"] < 4 / 192**0.5
    text = spark.createDataFrame([("same line\n" * 299 + "same line",)], "t string").select(fingerprints.fingerprint(F.col("t")).alias("v")).first()["v"]
    assert text == repeated("same line", 300)


# op2


def test_a_long_repeated_passage_is_cut_and_short_ones_stay(spark):
    rng = random.Random(9)
    fresh = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))
    passage, phrase = fresh(90), "as was said before"
    texts = [fresh(80) + " " + passage + " " + fresh(40), fresh(50) + " " + phrase, fresh(33) + " " + passage + " " + fresh(70), phrase + fresh(40), None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in chunks.remove_repeats(df).collect()}
    assert [got[i]["text"] for i in (0, 1, 3, 4, 5)] == [texts[i] for i in (0, 1, 3, 4, 5)]
    assert len(texts[2]) - len(passage) <= len(got[2]["text"]) < len(texts[2]) - 0.6 * len(passage)
    assert all(s["first_doc"] == 0 for s in got[2]["_spans"])


def test_chunks_follow_the_content():
    rng = np.random.default_rng(1)
    points = rng.integers(97, 123, 20_000).astype(np.uint32)
    moved = np.insert(points, 50, [97, 98, 99])
    a, b = set(chunks.ends_of(points)), {c - 3 for c in chunks.ends_of(moved)}
    assert len(a & b) > 0.95 * len(a)
    assert chunks.ends_of(points)[-1] == len(points) and chunks.ends_of(points[:0]) == []
    naive = []
    h = 0
    for i, p in enumerate(points[:300]):
        h = (h << 1) + int(chunks.GEAR[p]) & 0xFFFF
        naive.append(h)
    assert naive[20:] == chunks.gear_hash(points[:300])[20:].tolist()


def brute_spans(texts: dict[int, str]) -> dict[int, list]:
    """Chunks that an earlier document, or an earlier place, holds; joined, the long ones."""
    seen: dict[str, int] = {}
    out = {}
    for i in sorted(texts):
        at, runs, own = 0, [], set()
        t = texts[i] or ""
        for end in chunks.ends_of(np.frombuffer(t.encode("utf-32-le"), np.uint32)):
            piece = t[at:end]
            if piece in seen or piece in own:
                if runs and runs[-1][1] == at:
                    runs[-1][1] = end
                else:
                    runs.append([at, end])
            own.add(piece)
            at = end
        for piece in own:
            seen.setdefault(piece, i)
        out[i] = [(a, b - a) for a, b in runs if b - a >= chunks.MIN_RUN]
    return out


@pytest.mark.parametrize("hot", [chunks.HOT_ROWS, 0])
def test_spans_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(chunks, "HOT_ROWS", hot)
    monkeypatch.setattr(chunks, "SALTS", 3)
    rng = random.Random(21)
    passages = [prose(rng, 60) for _ in range(6)]
    texts = {i: "".join(rng.choice([prose(rng, rng.randint(1, 50)), rng.choice(passages), passages[0]]) for _ in range(rng.randint(0, 6))) for i in range(60)}
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in texts.items()], "doc_id long, text string, _spans int, _nth int, Salt int").repartition(5)
    found = chunks.remove_repeats(df)
    got = {r["doc_id"]: r for r in found.collect()}
    want = brute_spans(texts)
    assert any(want.values()) and {i: [(s["start"], s["size"]) for s in r["_spans"] or []] for i, r in got.items()} == want
    assert all(r["_spans_aside"] == 1 and r["_nth"] == 2 and r["Salt"] == 3 for r in got.values()) and chunks.without_repeats(df).columns == df.columns
    for i, r in got.items():
        kept, at = "", 0
        for start, size in want[i]:
            kept, at = kept + texts[i][at:start], start + size
        assert r["text"] == kept + texts[i][at:]


def test_repeats_edge_rows(docs, none, rows):
    assert chunks.remove_repeats(docs).count() == len(rows) and chunks.remove_repeats(none).count() == 0
    assert chunks.without_repeats(docs).columns == docs.columns


# op3


def test_chat_round_trip_and_order(spark):
    odd = "<|im_end|><|im_start|>assistant ok"
    rows = [(1, 0, "system", "s"), (1, 1, "user", odd), (1, 2, "assistant", "<\\|im_end|>\n" + odd), (2, 0, "assistant", "first"), (2, 1, None, None), (3, 0, "user", ""), (3, 1, "us\ner\\n", "x"), (None, 0, "user", "n")]
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    for conv, turns in itertools.groupby(rows, lambda r: r[0]):
        turns = list(turns)
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == sha("".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in turns))
        assert got[conv]["loss_sha256"] == sha("".join(t or "" for _, _, r, t in turns if r == "assistant"))
    assert got[1]["valid"] and got[1]["complete"] and not got[2]["valid"] and not got[3]["valid"]
    assert chat.read_back(chat.format_chat(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


TEMPLATES = (
    chat.TEMPLATE,
    (("[{role}]: ", frozenset()), ("{text}", frozenset({"assistant"})), ("</s>\n\n", frozenset())),
    (("<role={role}>", frozenset()), ("{text}", frozenset({"assistant"})), ("#END#", frozenset())),
)


@pytest.mark.parametrize("template", TEMPLATES)
def test_any_template_is_read_back(spark, template):
    """Texts and roles made of the templates' own control strings, their parts, backslashes and line ends."""
    rng = random.Random(2)
    parts = ["<", "|", "\\", "im_end", "<|im_end|>\n", "</s>\n\n", "[", "]", ": ", "#", "#END#", "n", "\n", "user", "<role=", ">", "é", "93;"]
    some = lambda n: "".join(rng.choice(parts) for _ in range(rng.randint(0, n)))
    talks = {c: [(rng.choice(["user", "assistant", some(4)]), some(9)) for _ in range(rng.randint(1, 6))] for c in range(60)}
    turns = spark.createDataFrame([(c, t, *x) for c, rows in talks.items() for t, x in enumerate(rows)], "conv_id long, turn long, role string, text string")
    for r in chat.read_back(chat.format_chat(turns, template), template).collect():
        rows = talks[r["conv_id"]]
        said = "".join(t for role, t in rows if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (len(rows), sha("".join(f"{a}\n{t}\n" for a, t in rows)), len(said), sha(said))


def test_templates_that_cannot_be_read():
    for bad in ((("{text}", frozenset()),), (("{role}", frozenset()), ("{text}", frozenset()), ("<|e|>", frozenset())), (("[{role}]", frozenset()), ("{text}", frozenset()), ("===", frozenset())), (("[{role}]", frozenset()), ("{text}!", frozenset()))):
        with pytest.raises(ValueError, match="template"):
            chat.Form(bad)


# op5


def brute_simhash(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_covering_masks_miss_no_pair():
    masks = simhash.covering_masks()
    assert len(masks) == 15
    rng = random.Random(1)
    for _ in range(20_000):
        d = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(d & m == 0 for m in masks)


def test_simhash_components_equal_brute_force(spark, docs, rows, none):
    got = sorted(((r["doc_id"], r["fp"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()), key=repr)
    fps = [brute_simhash(r[1]) for r in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for i, j in itertools.combinations(range(len(rows)), 2):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                group[i] = group[j] = min(group[i], group[j])
    low = {g: min((r[0] for r, x in zip(rows, group) if x == g and r[0] is not None), default=None) for g in set(group)}
    assert got == sorted(((r[0], simhash.signed(f), low[g]) for r, f, g in zip(rows, fps, group)), key=repr)
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("group", [simhash.GROUP, 5])
def test_links_connect_all_near_fingerprints(spark, monkeypatch, group):
    monkeypatch.setattr(simhash, "GROUP", group)
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(15)})
    edges = [(r["a"], r["b"]) for r in simhash.links(spark.createDataFrame([(simhash.signed(x),) for x in fps], "fp long")).collect()]
    parent = {simhash.signed(x): simhash.signed(x) for x in fps}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= 3
        parent[find(a)] = find(b)
    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= 3:
            assert find(simhash.signed(a)) == find(simhash.signed(b))


def test_a_large_group_of_near_fingerprints_is_dealt_again():
    rng = np.random.default_rng(3)
    fps = np.unique(np.bitwise_xor.reduce(np.left_shift(np.int64(1), rng.integers(0, 32, (20_000, 6))), axis=1))
    a, b = simhash.group_links(fps, 3, (1 << 32) - 1)
    place = {x: i for i, x in enumerate(fps.tolist())}
    parent = list(range(len(fps)))

    def find(v: int) -> int:
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for x, y in zip(a, b):
        assert (x ^ y).bit_count() <= 3
        parent[find(place[x])] = find(place[y])
    for i in rng.integers(0, len(fps), 300).tolist():
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3).tolist():
            assert find(i) == find(j)


# op6


def test_packing_holds_every_token_once(docs, rows, none):
    from tokenizers import Tokenizer

    inner = Tokenizer.from_file(packing.vocabulary_path())
    want = Counter()
    for r in rows:
        want[(r[0], tuple(inner.encode(r[1] or "", add_special_tokens=False).ids + [2]))] += 1
    got = packing.pack(docs, packing.vocabulary_path(), sequence=256).toPandas()
    assert got["length"].sum() == sum(len(k[1]) * n for k, n in want.items())
    sizes = []
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g["offset"].tolist() == [0, *np.cumsum(g["length"])[:-1].tolist()]
        sizes.append(int(g["length"].sum()))
    assert all(s == 256 or s & (s - 1) == 0 for s in sizes) and sum(s != 256 for s in sizes) <= 8
    for (doc, ids), n in want.items():
        if doc is not None and doc not in (3, 7):
            g = got[got["doc_id"] == doc].sort_values("start")
            assert (g["doc_tokens"] == len(ids)).all() and g["start"].tolist() == [0, *np.cumsum(g["length"])[:-1].tolist()]
            for s, k, crc in zip(g["start"], g["length"], g["ids_crc32"]):
                assert zlib.crc32(np.array(ids[s : s + k], "<u4").tobytes()) == crc
    assert packing.pack(none, packing.vocabulary_path()).count() == 0


def test_packing_plan_keeps_the_proportions():
    totals = np.array([100_000, 5_000, 37, 1, 0])
    at = np.arange(0, totals.sum() + 1, 97)
    served = packing.Plan(totals).served(at)
    assert (served.sum(axis=1) == at).all() and (np.diff(served, axis=0) >= 0).all()
    assert np.abs(served - at[:, None] * totals / totals.sum()).max() <= 2


@pytest.mark.parametrize("weights", [None, [3.0, 1.0, 1.0, 0.5], [1.0, 1.0, 1.0, 1.0]])
def test_packing_plan_is_the_round_robin_of_due_times(weights):
    totals = [700, 40, 333, 0]
    plan = packing.Plan(totals, 64, weights)
    shares = weights or totals
    order = sorted(((k + 1) / shares[q], q) for q, n in enumerate(totals) for k in range(n))
    seen, brute = [0] * 4, [[0] * 4]
    for _, q in order:
        seen[q] += 1
        brute.append(list(seen))
    assert plan.served(np.arange(sum(totals) + 1)).tolist() == brute
    if weights:  # as long as all queues last, every window has the target proportions
        window = np.diff(plan.served(np.array([0, 64])), axis=0)[:, :3]
        assert np.abs(window - 64 * np.array(weights[:3]) / sum(weights[:3])).max() <= 1.5


def test_packing_plan_cuts_rows_in_bounded_steps(monkeypatch):
    plan = packing.Plan([900, 7, 50], 16)
    queue, lo, hi = np.array([0, 0, 1, 2]), np.array([0, 400, 0, 0]), np.array([400, 900, 7, 50])

    def placed() -> list:
        row, frm, to, number, offset = plan.pieces(queue, lo, hi)
        return sorted((int(plan.start(np.array([n]))[0]) + o + k, int(queue[r]), f + k) for r, f, t, n, o in zip(*(x.tolist() for x in (row, frm, to, number, offset))) for k in range(t - f))

    want = placed()
    assert [x[0] for x in want] == list(range(957))
    monkeypatch.setattr(packing, "CELLS", 12)
    assert placed() == want


def test_packing_by_weights(spark):
    docs = spark.createDataFrame([(i, "word " * 50, "a" if i % 2 else None) for i in range(60)], "doc_id long, text string, source string")
    got = packing.pack(docs, packing.vocabulary_path(), 128, weights={"a": 3.0}).toPandas()
    first = got[got["sequence_id"] < 10]
    assert abs(first[first["source"] == "a"]["length"].sum() / (10 * 128) - 0.75) < 0.02
    assert got["length"].sum() == 60 * 51


def test_buckets_follow_the_order_whatever_the_ids(spark):
    rng = random.Random(8)
    ids = [1, 2**62, -(2**62)] + [7] * 300 + [None] * 300 + [rng.randint(10, 10_000) for _ in range(400)] + [2**40 + i for i in range(300)]
    df = spark.createDataFrame([(x, rng.randint(-(2**63), 2**63 - 1)) for x in ids], "k long, tie long")
    rows = df.select("k", "tie", ordered_buckets(df, "k", "tie", 20).alias("b")).collect()
    rows = sorted(rows, key=lambda r: (r["k"] is not None, r["k"] or 0, r["tie"]))
    buckets = [r["b"] for r in rows]
    assert buckets == sorted(buckets) and max(Counter(buckets).values()) <= 60


def test_other_vocabularies_encode_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    coder, texts = packing.WordTokenizer(path), ["The  cat\n sat", "", None]
    inner = Tokenizer.from_file(path)
    assert not coder.by_words
    assert [np.frombuffer(x, coder.type).tolist() for x in coder.encode(texts)] == [inner.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_words_are_encoded_as_whole_texts_are(monkeypatch):
    from tokenizers import Tokenizer

    rng = random.Random(6)
    inner = Tokenizer.from_file(packing.vocabulary_path())
    parts = ["Abc", "ÉCOLE", "x!?", "it's", "\u0130stanbul", "e\u0301", "a1b", "...", "日本", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "\x1c", "\xa0", " ", "\n", "straße.", "</w>", "\u2028", "q" * 200]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", "  "]) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    monkeypatch.setattr(packing, "CHUNK", 700)
    coder = packing.WordTokenizer(packing.vocabulary_path(), 50)
    texts[7] = "lorem (ipsum) dolor-sit " * 200 + "z" * 900
    got = [x for i in range(0, 400, 16) for x in coder.encode(texts[i : i + 16])]
    assert [np.frombuffer(x, coder.type).tolist() for x in got] == [inner.encode(t, add_special_tokens=False).ids for t in texts]


def test_added_tokens_are_the_librarys(spark):
    """At both ends, doubled, inside a word, beside marks, in another case, cut by a blank: what the plain library gives."""
    from tokenizers import Tokenizer

    end, start = "<|endoftext|>", "<|startoftext|>"
    texts = [end, start, f"{end}{end}", f"hello {end} world", f"hello{end}world", f"it{start}'s {end}.", f"...{end}", f"{end}é{start}É", end.upper(), "<|endof text|>", f"<{end}>", f"{start}{end}" * 300, f"日本{end}日"]
    inner, coder = Tokenizer.from_file(packing.vocabulary_path()), packing.WordTokenizer(packing.vocabulary_path())
    assert [np.frombuffer(x, coder.type).tolist() for x in coder.encode(texts)] == [inner.encode(t, add_special_tokens=False).ids for t in texts]
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("source", F.lit("s")), packing.vocabulary_path()).collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in rows} == {k: len(inner.encode(t, add_special_tokens=False).ids) + 1 for k, t in enumerate(texts)}


# op7


def page(title: str, blocks: list[str], extra: str = "") -> str:
    body = "".join(f"<p>{b}</p>" for b in blocks)
    return (
        f"<html><head><title>{title}</title><style>p{{}}</style></head><body><nav><ul><li><a href='/'>home</a></li></ul></nav><div class='cookie-notice'>We use cookies</div>"
        f"<article><h1>{title}</h1>{body}<p>Subscribe to our letter today</p></article>{extra}<div id=comments><p>first!</p></div><footer>&copy; me</footer></body></html>"
    )


def test_wrappers_find_the_article(spark):
    pages = [(i, f"http://h.example/{i}", page(f"Title {i}", [f"Para&nbsp;{i}  {k} &amp; more" + " words" * 20 for k in range(1 + i % 4)], "<aside>links</aside>" if i % 2 else "")) for i in range(24)]
    pages += [(100, None, None), (101, "http://one.example/", "<div><p>Only <b>one</b><br>page<p>two</div>"), (102, "x", "")]
    got = {r["page_id"]: r["text"] for r in wrappers.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i in range(24):
        assert got[i] == "\n".join([f"Title {i}", *[f"Para {i} {k} & more" + " words" * 20 for k in range(1 + i % 4)]])
    assert got[100] == "" and got[101] == "Only one page\ntwo" and got[102] == ""


def test_wrapper_expression_has_slots_repeats_and_options():
    wrapper = wrappers.infer([page(f"T{i}", [f"x{i}"] * (1 + i), "<aside>a</aside>" if i % 2 else "") for i in range(4)])
    shown = wrappers.expression(wrapper)
    assert "#PCDATA" in shown and ")+" in shown and "(<aside>)?" in shown


def test_wrappers_select_the_article_without_names(spark):
    """Boxes without telling names: slots alone tell the article, in two parts, from small ones."""
    rng = random.Random(11)
    words = lambda n: " ".join(rng.choice(WORDS) + str(rng.randrange(999)) for _ in range(n))
    pages, want = [], {}
    for i in range(40):
        parts = [words(rng.randint(15, 40)) for _ in range(4)]
        want[i] = "\n".join([f"T{i}", *parts])
        body = f"<section><h2>T{i}</h2><table><tr><td><ul><li><b>{parts[0]}</b></ul></table><p>{parts[1]}</section><section class='has-ad comments'><p>{parts[2]}<p>{parts[3]}<p>Read on here</section>"
        pages.append((i, f"http://h.example/{i}", f"<body><div class=a1>{words(3)}</div><div class='post-{i}'>{body}</div><div class=b2><a href=/x>{words(30)}</a></div><div class=c3>{words(4)}</div>"))
    got = {r["page_id"]: r["text"] for r in wrappers.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == want


def test_wrappers_are_learned_from_all_pages(spark):
    """One page of 60 has another byline, so that no byline is a constant; and what pages share that are too long for a sample is one."""
    words = lambda i, n: " ".join(f"w{i}x{k}" for k in range(n))
    pages = [(i, f"http://h.example/{i}", f"<body><div><h1>Title {i}</h1><p>By {'Ann' if i == 17 else 'Staff'}</p><p>{words(i, 60)}</p></div></body>") for i in range(60)]
    pages += [(100 + i, f"http://long.example/{i}", f"<body><div><p>Read on here</p><p>{words(i, 25_000)}</p></div></body>") for i in range(5)]
    got = {r["page_id"]: r["text"] for r in wrappers.extract(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)).collect()}
    want = {i: f"Title {i}\nBy {'Ann' if i == 17 else 'Staff'}\n{words(i, 60)}" for i in range(60)} | {100 + i: words(i, 25_000) for i in range(5)}
    assert [i for i in want if got[i] != want[i]] == []


def test_wrappers_do_not_hold_what_few_pages_have(spark):
    rng = random.Random(8)
    odd = lambda: "".join(f"<{t} class={rng.choice('abcdefgh')}>{rng.random()}</{t}>" for t in rng.choices(["div", "h2", "table", "pre", "ul"], k=40))
    pages = [("h", f"<body><div class=top>Menu of the site</div><article><p>{rng.random()}</p></article>{odd()}</body>") for _ in range(40)]
    found = json.loads(wrappers.wrappers(spark.createDataFrame(pages, "host string, html string")).first()["wrapper"])
    assert found["pages"] == 40 and "Menu of the site" in [x[1] for x in found["items"]]
    assert min(x[2] for x in found["items"]) >= wrappers.MIN_SEEN and len(found["items"]) < len(wrappers.infer([x for _, x in pages])["items"]) / 2


def test_learning_does_not_depend_on_where_pages_lie(spark, monkeypatch):
    """Many small groups and rounds, copies among the pages, joins that shuffle."""
    rng = random.Random(3)
    pages = [(i, f"http://h.example/{i}", page(f"T{i}", [f"x{i} {rng.choice(WORDS)}"] * (i % 5), "".join(rng.choice(["<hr>", "<div>a</div>", "<ul><li>b</ul>"]) for _ in range(i % 7)))) for i in range(60)]
    pages += pages[:20]
    docs = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = docs.select(F.lit("h").alias("host"), "html")
    one = wrappers.wrappers(rows.coalesce(1)).collect()
    assert wrappers.wrappers(rows.repartition(7)).collect() == one and json.loads(one[0]["wrapper"])["pages"] > 8
    want = sorted(map(str, wrappers.extract(docs).collect()))
    for name, value in (("HELD", 100), ("MAX_BROADCAST_CHARS", 0), ("MAX_BROADCAST_ROWS", 0)):
        monkeypatch.setattr(wrappers, name, value)
    assert sorted(map(str, wrappers.extract(docs).collect())) == want
    monkeypatch.setattr(wrappers, "FAN", 2)
    found = wrappers.wrappers(rows).collect()
    assert len(found) == 1 and json.loads(found[0]["wrapper"])["pages"] == json.loads(one[0]["wrapper"])["pages"]


def test_copies_are_no_template():
    text = "".join(f"<p>Part {k} of a page that many copies on this host repeat in full length, word by word.</p>" for k in range(6))
    same = [f"<body><div>menu</div><div class=x><h1>Title</h1>{text}</div></body>"] * 8
    found = wrappers.main_text(same[0], json.dumps(wrappers.infer(same)))
    assert found.startswith("Title\nPart 0") and found.count("\n") == 6


def test_wrapper_alignment_equals_a_plain_one_on_small_input():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ([rng.choice("abcdefgh#") + str(rng.randrange(4)) for _ in range(rng.randint(0, 30))] for _ in range(2))
        found = list(wrappers.blocks_of(a, b))
        assert all(a[i : i + n] == b[j : j + n] for i, j, n in found) and all(i + n <= k and j + n <= m for (i, j, n), (k, m, _) in itertools.pairwise(found))
        once = {x for x in a if a.count(x) == 1 and b.count(x) == 1}
        assert not once or found


def test_extraction_edge_pages(spark, none):
    deep = "<div>" * 3000 + "<p>deep text of some words" + "</div>" * 3000
    wide = "<ul>" + "".join(f"<li><a href=/{i}>item {i}</a> note {i % 7}" for i in range(30_000)) + "</ul>"
    rows = [(1, "http://a.b/", deep, "h"), (1, "http://a.b/", deep, "h"), (None, "x", "<p>one &lt;two&gt; <br>three<script>no</script><!-- no", "h"), (3, "http://a.b/w", wide, "h"), (4, None, "<p>" + "long " * 60_000, "h")]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string, host string").withColumns({"salt": F.lit(1), "wrapper": F.lit("w"), "text": F.lit("t")})
    got = wrappers.extract(docs, "main")
    found = got.collect()
    assert got.columns == [*docs.columns, "main"] and all(r["host"] == "h" and r["salt"] == 1 and r["wrapper"] == "w" and r["text"] == "t" for r in found)
    texts = [r["main"] for r in sorted(found, key=lambda r: (r["page_id"] is None, r["page_id"]))]
    assert texts[:2] == ["deep text of some words"] * 2 and texts[4] == "one <two> three" and len(texts[3]) == 5 * 60_000 - 1
    assert wrappers.extract(docs).columns == ["page_id", "url", "html", "host", "salt", "wrapper", "text"] and wrappers.extract(docs.limit(0)).count() == 0


# op8


def test_language_phrases_equal_a_plain_parse():
    model = language.Model({"aa": "the cat sat on the mat", "bb": "der hund lief um das haus"})
    texts = ["the dog sat", "das haus", "x", "", "the cat sat on the mat " * 60]
    count, _ = model.phrases(texts)
    known = {"aa": "the cat sat on the mat", "bb": "der hund lief um das haus"}
    for t, row in zip(texts, count):
        for k, name in enumerate(model.languages):
            total = 0
            clean = t
            for lo in range(0, len(clean), language.BLOCK):
                block, i = clean[lo : lo + language.BLOCK], 0
                while i < len(block):
                    n = 1
                    while i + n < len(block) and block[i : i + n + 1] in known[name]:
                        n += 1
                    i += n
                    total += 1
            assert row[k] == total, (t, name)


@pytest.mark.parametrize("cells", [0, language.DENSE_CELLS])
def test_language_tables_are_alike(monkeypatch, cells):
    """Every letter is told apart, however many there are, in both kinds of tables."""
    monkeypatch.setattr(language, "DENSE_CELLS", cells)
    rng = random.Random(3)
    han = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(1500))
    kana = "".join(chr(0x3041 + rng.randrange(80)) for _ in range(1500))
    model = language.Model({"han": han, "kana": kana, "aa": "the cat sat on the mat"})
    assert len(model.points) > 900
    names, scores, inside = model.predict([han[100:400], kana[50:300], "the cat", "\u0416" * 100, "", None])
    assert names == ["han", "kana", "aa", names[3], "und", "und"] and inside.tolist() == [True, True, True, False, False, False]
    count, sizes = model.phrases([han[5:9], "the mat the"])
    assert count[0, 1] == 1 and sizes.tolist() == [4, 11]


def test_language_learns_from_long_rows_and_all_languages(spark):
    rng = random.Random(5)
    letters = [[chr(97 + rng.randrange(26)) for _ in range(8)] for _ in range(70)]
    words = ["".join(rng.choice(x) for _ in range(60_000)) for x in letters]
    rows = [(None if k % 2 else k, "".join(w if i % 7 else " " for i, w in enumerate(t)), f"l{k:02}") for k, t in enumerate(words)]
    docs = spark.createDataFrame(rows + [(None, "same", "l00")] * 300, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.languages == sorted(f"l{k:02}" for k in range(70))


def test_language_stage_rejects_other_languages_and_keeps_columns(spark):
    rng = random.Random(6)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = [(10**6 + i, " ".join("".join(chr(0x0430 + rng.randrange(32)) for _ in range(rng.randint(2, 9))) for _ in range(60)), None, "s", 300) for i in range(8)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumns({"score": F.lit(0.9), "lang_pred": F.lit("x"), "predicted": F.lit(1)})
    got = language.in_known_language(docs)
    rows = got.collect()
    assert got.columns == docs.columns and all(r["score"] == 0.9 and r["lang_pred"] == "x" and r["predicted"] == 1 for r in rows)
    kept, known = {r["doc_id"] for r in rows}, {r["doc_id"] for r in docs.collect() if r["doc_id"] < 10**6}
    assert not any(i >= 10**6 for i in kept) and len(kept) >= 0.99 * len(known)


def test_language_accuracy_and_edges(spark, none):
    folder = "/root/testdata/sf0.001/documents.parquet"
    docs = spark.read.parquet(folder)
    model = language.fit(docs.where(~language.held_out()))
    got = language.predict(docs.where(language.held_out()), model).select("lang", "lang_pred").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.93 * len(got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !!"), (4, "the")], "doc_id long, text string")
    assert [r["lang_pred"] for r in language.predict(odd, model).orderBy("doc_id").collect()][:3] == ["und"] * 3
    assert language.in_known_language(none).count() == 0


# op9


def test_base_score_and_trie_sum_to_one(spark, docs, rows, none):
    got = ppm.score(docs, F.coalesce(F.col("doc_id"), F.lit(1)) % 4 != 1).collect()
    counts = Counter()
    for r in rows:
        if (1 if r[0] is None else r[0]) % 4 != 1:
            counts.update(ppm.words_of(r[1]) + [ppm.END])
    n, v = sum(counts.values()), len(counts)
    want = sorted((repr(r[0]), len(w := ppm.words_of(r[1]) + [ppm.END]), sum(counts[x] > 0 for x in w), round(sum(np.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6)) for r in rows)
    assert sorted((repr(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["train_tokens"] == n and r["score"] < 0 for r in got) and ppm.score(none, F.lit(True)).count() == 0


@pytest.mark.parametrize("least", [1, 3])
def test_ppm_probabilities_sum_to_one(least):
    keys, _ = ppm.grams_of(["the cat sat on the mat", "the dog", "cats and dogs sat"], 3)
    top, n = np.unique(keys, return_counts=True)
    grams, counts = [], []
    for k in range(3, -1, -1):
        u, back = np.unique(top & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
        c = np.bincount(back, weights=n).astype(np.int64)
        total = Counter()
        for g, x in zip(u.tolist(), c.tolist()):
            total[g >> 8] += x
        kept = np.array([total[g >> 8] >= least for g in u.tolist()])
        grams.append(u[kept] | k << 56)
        counts.append(c[kept])
    trie = ppm.Trie(np.concatenate(grams), np.concatenate(counts), 3)
    for context in (b"the", b" ca", b"xyz", b"zat", b"at ", b"\n\n\n"):
        c = int.from_bytes(context, "big")
        assert abs((10 ** trie.log10(np.array([c << 8 | s for s in range(256)]))).sum() - 1) < 1e-9


# op10


def test_byte_bpe_equals_the_library(spark, docs, rows):
    import public_tokenizers
    import tiktoken

    path = bytepair.vocabulary_path()
    coder = bytepair.codec(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    rng = random.Random(4)
    parts = ["a", "B", "é", "1", "٣", " ", "  ", "\n", "\t", "'", "'s", "'ll", "'re", "!", "..", "\xa0", "　", "ve", "日", "😀", "\0", "-"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 50))) for _ in range(3000)] + ["", "a" * 3000, " " * 300, "ab" * 800]
    for t, ids in zip(texts, coder.encode(texts)):
        ids = np.frombuffer(ids, "<i4").tolist()
        assert ids == library.encode_ordinary(t), repr(t)
        ids = np.array(ids, np.int64)
        bounds = np.array([0, len(ids)])
        assert coder.decode(ids, coder.ends(ids, bounds), bounds)[0].tobytes() == t.encode()
    got = bytepair.decode(bytepair.encode(docs, path), path).collect()
    assert sorted(map(repr, bytepair.encode(docs, path, decoded=True).collect())) == sorted(map(repr, got))
    cut = bytepair.decode(bytepair.encode(docs, path).select("doc_id", F.slice("ids", 1, 3).alias("ids"), F.slice("ends", 1, 3).alias("ends")), path).where("doc_id = 0").first()
    assert cut["decoded"].decode("utf-8", "ignore") == rows[0][1][: len(cut["decoded"].decode("utf-8", "ignore"))] and len(cut["decoded"]) == cut["ends"][-1]
    assert bytepair.encode(docs.limit(0), path, decoded=True).count() == 0
    assert sorted((repr(r["doc_id"]), tuple(r["ids"]), bytes(r["decoded"])) for r in got) == sorted((repr(r[0]), tuple(library.encode_ordinary(r[1] or "")), (r[1] or "").encode()) for r in rows)
    assert all(list(r["ends"]) == np.cumsum([len(coder.bytes[i]) for i in r["ids"]]).tolist() for r in got)


def test_every_code_point_is_of_the_librarys_class():
    """In a text where its class decides both boundaries beside it."""
    import public_tokenizers
    import tiktoken

    coder = bytepair.codec(bytepair.vocabulary_path())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    points = [*range(0xD800), *range(0xE000, 0x32400), *range(0xE0000, 0xE0200), 0x10FFFF]
    texts = ["".join(f"a{chr(c)}1{chr(c)}! {chr(c)} " for c in points[k : k + 256]) for k in range(0, len(points), 256)]
    for t, ids in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<i4").tolist() == library.encode_ordinary(t)
