"""Stored tables of which changes rewrite a part, states published together, maintained totals."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from gleaner.operators import maintained, ranking
from gleaner.sources.keyed import Keyed, Published, delete_cascade

ROWS = "id long, name string, size int"


def files(path) -> dict[str, float]:
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def rows_of(df) -> list:
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def stored(spark, tmp_path):
    rows = [(k, f"n{k}", k) for k in range(40)] + [(None, "no key", 1), (None, "no key", 1)]
    return Keyed(spark, str(tmp_path / "t"), parts=8).create(spark.createDataFrame(rows, ROWS))


def test_a_change_rewrites_the_partitions_of_its_keys_alone(spark, stored):
    before, old = files(stored.path), rows_of(stored.read())
    touched = stored.update(spark.createDataFrame([(3, None, 99)], ROWS))
    after = files(stored.path)
    part = f"_part={touched[0]}/"
    assert len(touched) == 1 and {f for f in before if part not in f} == {f for f in after if part not in f}
    assert all(before[f] == after[f] for f in before if part not in f) and not {f for f in before if part in f} & set(after)
    assert rows_of(stored.read()) == sorted([(3, "n3", 99) if r[0] == 3 else r for r in old], key=repr)


def test_upserts_updates_and_deletes(spark, stored):
    model = {r[0]: r for r in rows_of(stored.read()) if r[0] is not None}
    rng = random.Random(7)
    for step in range(4):
        new = {k: (k, rng.choice([None, "", f"new{step}"]), rng.randrange(9)) for k in rng.sample(range(60), 8)}
        stored.upsert(spark.createDataFrame([*new.values(), (None, "x", 1)], ROWS), ["name"])
        model |= {k: (k, (v[1] or model[k][1]) if k in model else v[1], model[k][2] if k in model else v[2]) for k, v in new.items()}
        gone = rng.sample(range(60), 5)
        stored.delete(spark.createDataFrame([(k,) for k in [*gone, *gone]], "id long"))
        model = {k: v for k, v in model.items() if k not in gone}
        assert rows_of(stored.read().where("id IS NOT NULL")) == sorted(model.values(), key=repr)
    assert stored.read().where("id IS NULL").count() == 2


def test_a_partition_can_lose_all_rows(spark, stored):
    stored.delete(stored.read().select("id"))
    assert rows_of(stored.read()) == [(None, "no key", 1)] * 2
    assert stored.delete(spark.createDataFrame([], "id long")) == [] == stored.update(spark.createDataFrame([(None, "x", 1)], ROWS))


def test_an_empty_table(spark, tmp_path):
    empty = Keyed(spark, str(tmp_path / "e"), parts=4).create(spark.createDataFrame([], ROWS))
    assert empty.read().count() == 0
    empty.upsert(spark.createDataFrame([(1, "a", 2)], ROWS), ["name"])
    assert rows_of(empty.read()) == [(1, "a", 2)]


def test_deletes_take_children_along(spark, tmp_path, stored):
    children = [(10 * k + j, k) for k in range(40) for j in range(3)] + [(999, None)]
    make = lambda name, key: Keyed(spark, str(tmp_path / name), key, 8).create(spark.createDataFrame(children, "cid long, venue_id long"))
    by_reference, by_own = make("a", "venue_id"), make("b", "cid")
    delete_cascade(stored, spark.createDataFrame([(4,), (5,), (None,), (77,)], "id long"), [(by_reference, "venue_id"), (by_own, "venue_id")])
    left = sorted([c for c in children if c[1] not in (4, 5)], key=repr)
    assert rows_of(by_reference.read()) == left == rows_of(by_own.read())
    assert {r[0] for r in rows_of(stored.read())} == {None, *range(40)} - {4, 5}


def test_a_commit_is_seen_whole_or_not_at_all(spark, tmp_path):
    store = Published(spark, str(tmp_path / "s"))
    assert store.tables() == {} and store.last()[0] == 0
    one = spark.range(5).toDF("id")
    store.commit(lambda _: {"a": one, "b": one})
    broken = one.select(F.raise_error(F.lit("broken off")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken off"):  # after a's next state was written
        store.commit(lambda t: {"a": t["a"].where("id > 1"), "b": broken})
    assert {k: v.count() for k, v in store.tables().items()} == {"a": 5, "b": 5} and store.last()[0] == 1
    readers = store.tables()
    store.commit(lambda t: {"a": t["a"].where("id > 1")})
    assert {k: v.count() for k, v in store.tables().items()} == {"a": 3, "b": 5} and readers["a"].count() == 5


def test_totals_follow_every_change(spark):
    rng = random.Random(3)
    kind = "id long, status string, cents long"
    value = lambda: (rng.choice(["a", "b", None]), rng.choice([None, rng.randrange(100)]))
    state = {k: value() for k in range(50)}
    frame = lambda s: spark.createDataFrame([(k, *v) for k, v in s.items()], kind)
    by, sums = ["status"], {"cents": F.col("cents"), "large": (F.col("cents") > 50).cast("long")}
    stored = maintained.totals(frame(state), by, sums)
    for _ in range(3):
        after = {k: v for k, v in state.items() if rng.random() > 0.2} | {rng.randrange(80): value() for _ in range(15)}
        change = maintained.signed(frame(state), frame(after), "id")
        assert change.count() == sum((state.get(k) is not None) + (after.get(k) is not None) for k in state.keys() | after.keys() if state.get(k) != after.get(k))
        stored, state = maintained.merged(stored, maintained.totals(change, by, sums, "sign"), by), after
        assert rows_of(stored) == rows_of(maintained.totals(frame(state), by, sums).select(stored.columns))
    empty = maintained.totals(maintained.signed(frame(state), frame(state).limit(0), "id"), by, sums, "sign")
    assert maintained.merged(stored, empty, by).count() == 0


def test_places_are_those_of_all_items(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice([None, *range(9)])) for k in range(200)] + [(500, 77)]
    scores = [s for _, s in rows]
    key = lambda s: (s is None, -(s or 0))
    want = {k: (1 + sum(key(x) < key(s) for x in scores), 1 + len({x for x in scores if key(x) < key(s)}), sum(key(x) > key(s) for x in scores) / 200, sum(key(x) < key(s) for x in scores) / 200) for k, s in rows}
    found = ranking.places(spark.createDataFrame(rows, "item long, score int"), "item").collect()
    assert {r["item"]: (r["place"], r["dense"], r["share_below"], r["percent_rank"]) for r in found} == want and len(found) == len(rows)
    one = ranking.places(spark.createDataFrame([(1, 5)], "item long, score int"), "item").first()
    assert (one["place"], one["dense"], one["share_below"], one["percent_rank"]) == (1, 1, 0.0, 0.0)
    assert ranking.places(spark.createDataFrame([], "item long, score int"), "item").count() == 0
