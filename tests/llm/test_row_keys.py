"""op2 where ids are missing or repeated."""

from __future__ import annotations

from gleaner.llm import chunks


def test_spans_belong_to_rows_not_ids(spark):
    a, b, c, d = ("".join(f"{k}{i * i} word{i} " for i in range(80)) for k in "pqrs")
    rows = [(1, a), (2, a), (2, b), (None, a), (None, c), (None, b), (5, d), (5, d), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r["doc_id"], r["text"]) for r in chunks.remove_repeats(docs).collect()]
    want = [(1, a), (2, ""), (2, b), (None, ""), (None, c), (None, ""), (5, d), (5, ""), (None, None)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = [(r["doc_id"], r["text"]) for r in chunks.without_repeats(docs).collect()]
    assert sorted(kept, key=repr) == sorted([x for x in want if x[1] != ""], key=repr)
