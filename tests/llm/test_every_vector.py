"""op4 returns each row once; components never stop unfinished."""

from __future__ import annotations

import pytest

from gleaner.llm import covertree
from gleaner.llm.common import components


def test_one_row_per_vector(spark):
    v = [1.0, 0.5]
    rows = [(1, v, 1), (1, None, 1), (1, [0.0, 0.0], 1), (2, v, 1), (2, v, None), (None, v, 1), (None, None, 1), (3, [None, 1.0], 1)]
    got = covertree.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    want = [(1, 2, 1), (1, 0, 1), (1, 0, 1), (2, 2, 1), (2, 0, 2), (None, 2, 1), (None, 0, None), (3, 0, 3)]
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr) == sorted(want, key=repr)


def test_unfinished_components_are_an_error(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    with pytest.raises(RuntimeError):
        components(edges, rounds=2).count()
