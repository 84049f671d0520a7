"""Every registered corpus query: its columns, its rows against a brute-force version on the
whole small tables, and stages of the pipeline on odd rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from gleaner.llm import bytepair, packing, ppm
from tests.llm.test_text_operators import brute_spans

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return {n: spark.read.parquet(f"{FOLDER}/{n}.parquet").collect() for n in ("documents", "embeddings", "pages", "conversations")}


def run(spark, start: str) -> tuple:
    (name,) = [n for n in __spark_entry__.queries() if n.startswith(start)]
    df = __spark_entry__.queries()[name](spark, FOLDER)
    return df, df.collect()


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def kinds(df, *wanted: tuple[str, str]) -> None:
    assert df.dtypes[: len(wanted)] == list(wanted)


def test_op1(spark, tables):
    df, rows = run(spark, "op1_")
    kinds(df, ("doc_id", "bigint"), ("n_chars", "bigint"), ("edited_sha256", "string"), ("fingerprint", "string"), ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double"))
    docs = sorted(tables["documents"], key=lambda r: -r["doc_id"])
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(docs)
    by_lines, errors = defaultdict(set), []
    for r, nxt in zip(docs, docs[1:] + docs[:1]):
        t, h = r["text"], len(r["text"]) // 2
        edited = t[: len(t) - h] + nxt["text"][:h]
        x = got[r["doc_id"]]
        assert x["n_chars"] == len(t) and x["edited_sha256"] == sha(edited)
        by_lines[tuple(sorted(t.split("\n")))].add(x["fingerprint"])
        by_lines[tuple(sorted(edited.split("\n")))].add(x["edited_fingerprint"])
        # the likeness estimates the cosine of the two texts' counts of lines
        for other, near in ((edited, x["near_edited"]), (nxt["text"], x["near_next"])):
            a, b = Counter(t.split("\n")), Counter(other.split("\n"))
            want = sum(a[k] * b[k] for k in a) / np.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
            assert abs(near - want) < 4.2 / np.sqrt(192) and 0 <= near <= 1
            errors.append(near - want)
    assert np.sqrt(np.mean(np.square(errors))) < 1 / np.sqrt(192)
    assert all(len(v) == 1 for v in by_lines.values()) and len({min(v) for v in by_lines.values()}) == len(by_lines)


def test_op2(spark, tables):
    df, rows = run(spark, "op2_")
    texts = {r["doc_id"]: r["text"] for r in tables["documents"]}
    want = brute_spans(texts)
    assert sorted(r["doc_id"] for r in rows) == sorted(texts) and any(want.values())
    for r in rows:
        assert list(zip(r["span_starts"] or [], r["span_sizes"] or [])) == want[r["doc_id"]] and all(x <= r["doc_id"] for x in r["first_docs"] or [])
        kept, at = "", 0
        for start, size in want[r["doc_id"]]:
            kept, at = kept + texts[r["doc_id"]][at:start], start + size
        assert r["text"] == kept + texts[r["doc_id"]][at:] and r["kept_chars"] == len(r["text"]) and r["n_chars"] == len(texts[r["doc_id"]])


def test_op3(spark, tables):
    df, rows = run(spark, "op3_")
    kinds(df, ("conv_id", "bigint"), ("n_turns", "bigint"), ("turns_sha256", "string"), ("loss_chars", "bigint"), ("loss_sha256", "string"), ("formatted_chars", "bigint"))
    said = "<|im_end|><|im_start|>assistant ok"
    turns = defaultdict(list, {-1: [("user", said), ("assistant", said)]})
    for r in sorted(tables["conversations"], key=lambda r: (r["conv_id"], r["turn"])):
        turns[r["conv_id"]].append((r["role"], r["text"] or ""))
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows} == {
        c: (len(t), sha("".join(f"{a}\n{b}\n" for a, b in t)), sum(len(b) for a, b in t if a == "assistant"), sha("".join(b for a, b in t if a == "assistant"))) for c, t in turns.items()
    }


def test_op4(spark, tables):
    df, rows = run(spark, "op4_")
    kinds(df, ("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean"))
    v = [r for r in tables["embeddings"] if r["label"] is not None]
    x = np.array([r["embedding"] for r in v], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r["label"] for r in v])
    hit = (x @ x.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(hit, False)
    ids, group = [r["vec_id"] for r in v], list(range(len(v)))
    for i, j in zip(*np.nonzero(hit)):
        old, new = max(group[i], group[j]), min(group[i], group[j])
        group = [new if g == old else g for g in group]
    low = {g: min(ids[i] for i in range(len(v)) if group[i] == g) for g in set(group)}
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in rows} == {k: (int(hit[i].sum()), low[group[i]], k == low[group[i]]) for i, k in enumerate(ids)}


def test_op5(spark, tables):
    df, rows = run(spark, "op5_")
    kinds(df, ("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint"))
    fps = {r["doc_id"]: int(r["fingerprint"], 16) for r in rows}
    ids = sorted(fps)
    group = {i: i for i in ids}
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if group[i] != group[j] and (fps[i] ^ fps[j]).bit_count() <= 3:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = {k: new if g == old else g for k, g in group.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == group and len(rows) == len(tables["documents"])


def test_op6(spark, tables):
    from tokenizers import Tokenizer

    df, rows = run(spark, "op6_")
    kinds(df, ("doc_id", "bigint"))
    assert {"start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(df.columns)
    inner = Tokenizer.from_file(packing.vocabulary_path())
    ids = {r["doc_id"]: inner.encode(r["text"] or "", add_special_tokens=False).ids + [2] for r in tables["documents"]}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for doc, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids[doc]) and r["ids_crc32"] == zlib.crc32(np.array(ids[doc][at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids[doc])
    total = Counter()
    for r in tables["documents"]:
        total[r["source"]] += len(ids[r["doc_id"]])
    for number, pieces in by_sequence.items():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == [0, *np.cumsum([r["length"] for r in pieces])[:-1].tolist()]
        size = sum(r["length"] for r in pieces)
        assert size == 4096 or size & (size - 1) == 0
        if size == 4096:  # each window holds each source by its share
            held = Counter()
            for r in pieces:
                held[r["source"]] += r["length"]
            assert all(abs(held[s] - 4096 * n / sum(total.values())) <= 2 for s, n in total.items())


def test_op7(spark, tables):
    import html
    import re

    df, rows = run(spark, "op7_")
    kinds(df, ("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint"))
    got = {r["page_id"]: r for r in rows}
    for r in tables["pages"]:
        article = re.search(r"<article>(.*?)</article>", r["html"] + "</article>", re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", x)))).strip() for x in re.split(r"</?(?:p|h1)>", article)]
        want = "\n".join(x for x in blocks if x)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_op8(spark, tables):
    df, rows = run(spark, "op8_")
    kinds(df, ("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double"))
    langs = {r["doc_id"]: r["lang"] for r in tables["documents"]}
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in langs if zlib.crc32(str(i).encode()) % 4 == 2} and len(rows) == len(langs)
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.93 * len(held) and all(0 <= r["score"] <= 1 for r in rows)


def test_op9(spark, tables):
    df, rows = run(spark, "op9_")
    kinds(df, ("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"), ("n_known", "bigint"), ("train_tokens", "bigint"), ("base_score", "double"), ("score", "double"))
    words = lambda t: "".join(c.lower() if c.isascii() else c for c in t or "").encode().split()
    fold = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1 for r in tables["documents"]}
    counts = Counter()
    for r in tables["documents"]:
        if not fold[r["doc_id"]]:
            counts.update([*words(r["text"]), None])
    n, v = sum(counts.values()), len(counts)
    texts = {r["doc_id"]: r["text"] for r in tables["documents"]}
    learned = [t for i, t in texts.items() if not fold[i]]
    top, often = np.unique(ppm.grams_of(learned)[0], return_counts=True)
    grams, number = [], []
    for k in range(ppm.ORDER + 1):
        u, back = np.unique(top & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
        grams.append(u | k << 56)
        number.append(np.bincount(back, weights=often).astype(np.int64))
    trie = ppm.Trie(np.concatenate(grams), np.concatenate(number))
    for r in rows:
        w = [*words(texts[r["doc_id"]]), None]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (fold[r["doc_id"]], len(w), sum(counts[x] > 0 for x in w), n)
        assert abs(r["base_score"] - sum(np.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)) < 1e-6
        assert abs(r["score"] - trie.log10(ppm.grams_of([texts[r["doc_id"]]])[0]).sum()) < 1e-6
    assert len(rows) == len(texts)


def test_op10(spark, tables):
    import public_tokenizers
    import tiktoken

    df, rows = run(spark, "op10_")
    kinds(df, ("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytepair.codec(bytepair.vocabulary_path()).ranks, special_tokens={})
    for r, want in zip(sorted(rows), sorted(tables["documents"], key=lambda r: r["doc_id"]), strict=True):
        ids = library.encode_ordinary(want["text"])
        assert (r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (want["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(want["text"]))


def test_stages_on_odd_rows(spark, tables):
    """Nulls in any column, empty and long texts, repeated rows and ids, clashing columns, no rows."""
    text = tables["documents"][5]["text"]
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (None, text + " more words here", None, None, None), (1, "otra cosa " * 30, None, "s", 2), (3, None, None, None, None), (4, "", "en", "s", 0), (5, "word " * 30_000, "en", "t", 9)]
    kept = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = kept.unionByName(spark.createDataFrame(rows, kept.schema)).selectExpr("*", "1 AS score", "'x' AS lang_pred", "2 AS _nth", "3 AS queue", "4 AS bucket", "5 AS tie")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and stage(spark, docs.limit(0), FOLDER).count() == 0
        found = out.collect()
        assert all((r["score"], r["lang_pred"], r["_nth"], r["queue"]) == (1, "x", 2, 3) for r in found) and any(r["doc_id"] == 5 and r["text"] for r in found)
    assert sum(r["doc_id"] == 1 and r["text"] == text for r in stage(spark, docs, FOLDER).collect()) <= 1
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).toPandas()
    assert packed.drop_duplicates(["doc_id", "doc_tokens"])["doc_tokens"].sum() > 30_000 and (packed["length"] > 0).all()
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), FOLDER).count() == 0
