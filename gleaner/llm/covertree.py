"""Exact near-duplicate pairs of embeddings by dual traversal of cover trees.

Unit vectors are compared by chord length, for which a cosine threshold is a radius.
Equal vectors of a label are folded into one first. The vectors of a label are a cell,
and every cell with over ``BLOCK_ROWS`` vectors is split by its nearest of at most
``PIVOTS`` pivots, again and again, which is the top of the tree, grown in Spark. A
vector is at home in one cell, and visits each other cell of its label in which a
partner may be, by the pivot's covering radius; of two cells only the vectors of
the first visit the second, so each pair meets once. A split that saves no work is not
made, so a cell without structure is left to blocks.

In each cell, blocks of homes and visitors become trees of nested levels whose covering
radii halve, and two trees are descended together: a pair of nodes farther apart than
both radii and the threshold is pruned, a pair nearer than the threshold less both
radii is linked whole, all others are opened. The distances of two nodes' children come
from one matrix product; a pair of vectors is decided by its cosine in double precision.

Only counts and a spanning set of links leave a unit of work, never all pairs.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components, and rows with a null label, link with nothing and are their own
component; vectors of different lengths never link; repeated rows are linked to each
other; repeated ids each return a row; an empty table gives none.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.common import components, cut, join_hot, table

COSINE = 0.93
#: Vectors of a block, and of a cell that is not split; the pivots of a cell at most; the
#: share of the work that a split must leave at most, where to move a vector to a unit of
#: work counts as so many comparisons.
BLOCK_ROWS, PIVOTS, SAVES, MOVED = 2000, 64, 0.7, 1200
LEAF = 16
SAFE = 1e-7  # bounds are widened by this much against rounding


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def chord(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


class Node:
    """Rows, covered by the center within the radius. Its children, covered within half of
    its level, are ``centers`` with ``radii``; ``nodes`` has those of several rows, by place."""

    __slots__ = ("center", "radius", "rows", "centers", "radii", "nodes")

    def __init__(self, center: int, radius: float, rows: np.ndarray) -> None:
        self.center, self.radius, self.rows = center, radius, rows
        self.centers, self.radii, self.nodes = np.zeros(0, int), np.zeros(0), {}


def cover_tree(x: np.ndarray, leaf: int | None = None) -> Node:
    """Nested levels over the rows of ``x``, from the largest chord down: a node's children
    are centres farther than half of its level apart which cover its rows within that half."""
    leaf = LEAF if leaf is None else leaf
    root = Node(0, float(chord(x @ x[0]).max(initial=0.0)) if len(x) else 0.0, np.arange(len(x)))
    open_ = [(root, 4.0)]
    while open_:
        top, level = open_.pop()
        if len(top.rows) <= leaf or top.radius == 0:
            continue
        while level / 2 >= top.radius:
            level /= 2
        half = level / 2
        far = chord(x[top.rows] @ x[top.rows].T)
        near = far <= half
        np.fill_diagonal(near, True)
        # rows that no other covers are centres; of the others one after another, first the node's own
        alone = near.sum(axis=1) == 1
        left = np.flatnonzero(~alone)
        at = int(np.flatnonzero(top.rows == top.center)[0])
        centers, radii = [np.flatnonzero(alone)], [np.zeros(int(alone.sum()))]
        place = len(centers[0])
        while len(left):
            at = at if at >= 0 and not alone[at] else int(left[0])
            own = left[near[at, left]]
            radius = float(far[at, own].max())
            centers.append(np.array([at]))
            radii.append(np.array([radius]))
            if len(own) > 1:
                top.nodes[place] = child = Node(int(top.rows[at]), radius, top.rows[own])
                open_.append((child, half))
            place += 1
            left, at = left[~near[at, left]], -1
        top.centers, top.radii = top.rows[np.concatenate(centers)], np.concatenate(radii)
    return root


class Links:
    """Counts of links (weighted by copies) of the rows of ``x`` and of ``y``, and links that
    connect all linked rows; ``seen`` counts node pairs pruned, linked whole and opened, and
    row pairs compared."""

    def __init__(self, x: np.ndarray, y: np.ndarray, wx: np.ndarray, wy: np.ndarray, cosine: float, seen: Counter) -> None:
        self.x, self.y, self.wx, self.wy, self.cosine, self.seen = x, y, wx, wy, cosine, seen
        self.reach = float(np.sqrt(2 - 2 * cosine))
        self.nx, self.ny = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []

    def take(self, i: np.ndarray, j: np.ndarray) -> None:
        """Every row of i is linked with every row of j."""
        self.nx[i] += self.wy[j].sum()
        self.ny[j] += self.wx[i].sum()
        self.a.append(np.concatenate([np.full(len(j), i[0]), i[1:]]))
        self.b.append(np.concatenate([j, np.full(len(i) - 1, j[0])]))

    def compare(self, i: np.ndarray, j: np.ndarray, hit: np.ndarray) -> None:
        """Rows i, j that are linked where ``hit``."""
        p, q = np.nonzero(hit)
        if len(p):
            np.add.at(self.nx, i[p], self.wy[j[q]])
            np.add.at(self.ny, j[q], self.wx[i[p]])
            p, q = forest(p, q, len(i), len(j), False)
            self.a.append(i[p])
            self.b.append(j[q])

    def block(self, i: np.ndarray, j: np.ndarray, one: bool = False) -> None:
        """All pairs of rows i and j; ``one``: of the same rows, each once."""
        hit = self.x[i] @ self.y[j].T >= self.cosine
        self.seen["rows"] += hit.size
        self.compare(i, j, np.triu(hit, 1) if one else hit)

    def meet(self, ca: np.ndarray, ra: np.ndarray, left: dict[int, Node], cb: np.ndarray, rb: np.ndarray, right: dict[int, Node], one: bool) -> list[tuple[Node, Node]]:
        """Of all pairs of two lists of nodes those to open. Nodes of one row are in no dict."""
        product = self.x[ca] @ self.y[cb].T
        single_a, single_b = np.ones(len(ca), bool), np.ones(len(cb), bool)
        single_a[list(left)], single_b[list(right)] = False, False
        # two rows: a pair is decided at once; most are far apart
        bound = ra[:, None] + rb + (self.reach + SAFE)
        live = 2 - 2 * product <= bound * bound
        if one:
            live &= np.arange(len(ca))[:, None] < np.arange(len(cb))
        self.seen["pruned"] += (live.size // 2 if one else live.size) - int(live.sum())
        i, j = np.nonzero(live)
        small = single_a[i] & single_b[j]
        self.seen["rows"] += int(small.sum())
        hit = small & (product[i, j] >= self.cosine)
        if hit.any():
            p, q = i[hit], j[hit]
            np.add.at(self.nx, ca[p], self.wy[cb[q]])
            np.add.at(self.ny, cb[q], self.wx[ca[p]])
            p, q = forest(p, q, len(ca), len(cb), False)
            self.a.append(ca[p])
            self.b.append(cb[q])
        out = []
        i, j = i[~small], j[~small]
        # single rows that are near a node of several meet it together
        for k, node in right.items():
            if len(rows := i[(j == k) & single_a[i]]):
                self.block(ca[rows], node.rows)
        for k, node in left.items():
            if len(rows := j[(i == k) & single_b[j]]):
                self.block(node.rows, cb[rows])
        many = ~single_a[i] & ~single_b[j]
        for p, q in zip(i[many].tolist(), j[many].tolist(), strict=True):
            a, b = left[p], right[q]
            if float(chord(product[p, q])) < self.reach - a.radius - b.radius - SAFE:
                self.seen["whole"] += 1
                self.take(a.rows, b.rows)
            else:
                out.append((a, b))
        self.seen["opened"] += len(out)
        return out + [(n, n) for n in left.values()] if one else out

    def descend(self, tree: Node, right: Node) -> None:
        alone = lambda n: (np.array([n.center]), np.array([n.radius]), {0: n} if len(n.rows) > 1 else {})
        below = lambda n: (n.centers, n.radii, n.nodes)
        stack = [(tree, right)] if tree is right else self.meet(*alone(tree), *alone(right), False)
        while stack:
            a, b = stack.pop()
            one = a is b
            if one and 2 * a.radius < self.reach - SAFE and len(a.rows) > 1:  # all within reach of each other
                self.seen["whole"] += 1
                self.nx[a.rows] += self.wx[a.rows].sum() - self.wx[a.rows]
                self.a.append(np.full(len(a.rows) - 1, a.rows[0]))
                self.b.append(a.rows[1:])
            elif not len(a.centers) and not len(b.centers):
                self.block(a.rows, b.rows, one)
            elif one:
                stack += self.meet(*below(a), *below(a), True)
            elif len(a.centers) and (not len(b.centers) or a.radius >= b.radius):
                stack += self.meet(*below(a), *alone(b), False)
            else:
                stack += self.meet(*alone(a), *below(b), False)


def dual_links(x: np.ndarray, y: np.ndarray | None, wx: np.ndarray, wy: np.ndarray, cosine: float, seen: Counter | None = None) -> tuple:
    """The counts and links of two blocks; ``y`` None: within ``x``, without row pairs i, i."""
    found = Links(x, x if y is None else y, wx, wy, cosine, Counter() if seen is None else seen)
    tree = cover_tree(x)
    found.descend(tree, tree if y is None else cover_tree(y))
    if y is None:
        found.nx += found.ny
    ends = (np.concatenate(found.a), np.concatenate(found.b)) if found.a else (np.zeros(0, int), np.zeros(0, int))
    return found.nx, found.ny, *ends


def forest(i: np.ndarray, j: np.ndarray, n: int, m: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Of the links i-j, some that connect the same rows."""
    parent = list(range(n if same else n + m))

    def find(v: int) -> int:
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    kept = []
    for k, (p, q) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
        u, v = find(p), find(q if same else n + q)
        if u != v:
            parent[v] = u
            kept.append(k)
    return i[kept], j[kept]


def can_link() -> F.Column:
    """Whether a row has a label and a finite vector other than zero; never null."""
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0)
    return F.coalesce(fine, F.lit(False))


def usable(vectors: DataFrame) -> DataFrame:
    """The rows that can link, with the vector in double precision."""
    return vectors.where(can_link()).select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def distances(v: pd.Series, pivots: pd.Series) -> pd.Series:
    """The chords from each vector to its cell's pivots."""
    out = []
    known: dict[int, np.ndarray] = {}
    for x, p in zip(v, pivots, strict=True):
        if id(p) not in known:
            known = {id(p): unit(np.array([q["v"] for q in p]))}
        out.append(chord(known[id(p)] @ (x / np.linalg.norm(x))))
    return pd.Series(out)


CELL = ("label", "dim", "cell")


def sizes(rows: DataFrame, *more: str) -> DataFrame:
    return rows.groupBy(*CELL, *more).agg(F.count_if("home").alias("h"), F.count_if(~F.col("home")).alias("v"))


def split(rows: DataFrame, level: int, reach: float) -> DataFrame:
    """``rows`` in the cells below theirs: with ``cell`` and ``home`` there, and ``parent``."""
    counted = sizes(rows).select(*CELL, F.least(F.lit(PIVOTS), F.ceil(F.col("h") / (BLOCK_ROWS / 4))).cast("int").alias("k"))
    homes = rows.where("home").select(*CELL, "rep", F.xxhash64(F.lit(level), "v").alias("hash")).join(counted, list(CELL))
    # the vector of the smallest hash in each hash class
    chosen = homes.groupBy(*CELL, F.pmod("hash", F.col("k")).alias("slot")).agg(F.min_by("rep", "hash").alias("rep"))
    pivots = chosen.join(rows.where("home").select(*CELL, "rep", "v"), [*CELL, "rep"]).groupBy(*CELL).agg(F.sort_array(F.collect_list(F.struct("slot", "v"))).alias("pivots"))
    far = cut(rows.join(pivots, list(CELL)).withColumn("away", distances("v", "pivots")).drop("pivots"))
    nearest = F.array_position("away", F.array_min("away")).cast("int")
    far = far.withColumn("own", F.when(F.col("home"), nearest))
    radii = far.where("home").groupBy(*CELL, "own").agg(F.max(F.element_at("away", F.col("own"))).alias("radius"))
    listed = radii.groupBy(*CELL).agg(F.collect_list(F.struct(F.col("own").alias("at"), "radius")).alias("below"))  # at most PIVOTS
    reached = F.filter("below", lambda c: F.element_at("away", c["at"]) <= c["radius"] + F.lit(reach))
    # of its siblings a home visits those after it; a visitor visits all in reach
    visits = F.transform(F.filter(reached, lambda c: F.col("own").isNull() | (c["at"] > F.col("own"))), lambda c: F.struct(c["at"].alias("at"), F.lit(False).alias("home")))
    there = F.when(F.col("home"), F.concat(F.array(F.struct(F.col("own").alias("at"), F.lit(True).alias("home"))), visits)).otherwise(visits)
    moved = far.join(listed, list(CELL)).select("label", "dim", F.col("cell").alias("parent"), "rep", "copies", "v", F.explode(there).alias("x"))
    return moved.select("label", "dim", F.xxhash64("parent", "x.at", F.lit(level)).alias("cell"), "parent", "rep", "copies", "v", "x.home")


def cells(reps: DataFrame, reach: float) -> DataFrame:
    """(label, dim, cell, rep, copies, v, home): every vector in its last cell and in those it visits."""
    rows = reps.select("label", "dim", F.xxhash64("label", "dim").alias("cell"), "rep", "copies", "v", F.lit(True).alias("home"))
    done, level = [], 0
    hb, vb = (F.ceil(F.col(c) / BLOCK_ROWS) for c in ("h", "v"))
    work = F.col("h") * (F.col("h") + F.col("v")) + MOVED * (F.col("h") * (hb + vb) + F.col("v") * hb)
    while True:
        before = cut(sizes(rows))
        large = before.where(F.col("h") > BLOCK_ROWS).select(*CELL, work.alias("before"))
        if large.isEmpty():
            return unioned([*done, rows])
        done.append(rows.join(large.select(*CELL), list(CELL), "left_anti"))
        rows = rows.join(large.select(*CELL), list(CELL), "left_semi")
        moved = cut(split(rows, level, reach))
        after = sizes(moved, "parent").groupBy("label", "dim", "parent").agg(F.sum(work).alias("after")).withColumnRenamed("parent", "cell")
        better = cut(large.join(after, list(CELL)).where(F.col("after") <= SAVES * F.col("before")).select(*CELL))
        done.append(rows.join(better, list(CELL), "left_anti"))
        parents = better.withColumnRenamed("cell", "parent")
        rows = cut(moved.join(parents, ["label", "dim", "parent"], "left_semi").drop("parent"))
        level += 1


def unioned(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def units_of(rows: DataFrame) -> DataFrame:
    """Rows of ``cells`` in units of work: two blocks of a cell's homes, p <= q, or one of them
    and a block of visitors. ``side``: 2 in one block, else 0 for the first, 1 for the other."""
    blocks = lambda c: F.ceil(F.col(c) / BLOCK_ROWS).cast("int")
    counted = sizes(rows).select(*CELL, blocks("h").alias("hb"), blocks("v").alias("vb"))
    placed = rows.join(counted, list(CELL)).withColumn("block", F.pmod(F.xxhash64("rep"), F.when(F.col("home"), F.col("hb")).otherwise(F.col("vb"))).cast("int"))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    own = F.col("block")
    pairs = F.transform(upto(F.col("hb")), lambda q: F.struct(F.least(own, q).alias("p"), F.greatest(own, q).alias("q"), F.when(own == q, 2).when(own < q, 0).otherwise(1).alias("side")))
    meets = F.transform(upto(F.col("vb")), lambda w: F.struct(own.alias("p"), (F.col("hb") + w).alias("q"), F.lit(0).alias("side")))
    comes = F.transform(upto(F.col("hb")), lambda p: F.struct(p.alias("p"), (F.col("hb") + own).alias("q"), F.lit(1).alias("side")))
    there = F.when(F.col("home"), F.concat(pairs, meets)).otherwise(comes)
    return placed.select(*CELL, "rep", "copies", "v", F.explode(there).alias("x")).select(*CELL, "x.p", "x.q", "x.side", "rep", "copies", "v")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Per row of ``vectors(vec_id, label, embedding)``: vec_id, n_links,
    component_id, kept. See the module for the method."""
    rows = usable(vectors.select("vec_id", "label", "embedding")).withColumn("dim", F.size("v"))
    rows = cut(rows.withColumns({"h1": F.xxhash64(F.lit(1), "v"), "h2": F.xxhash64(F.lit(2), "v")}))
    folded = rows.groupBy("label", "dim", "h1", "h2").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"), F.any_value("v").alias("v"))
    reps = cut(folded.withColumn("rep", F.monotonically_increasing_id()))
    units = units_of(cells(reps, float(np.sqrt(2 - 2 * cosine)) + SAFE))

    def work(keys: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        side = frame["side"].to_numpy()
        rep, copies = frame["rep"].to_numpy(np.int64), frame["copies"].to_numpy(np.int64)
        v = frame["v"].to_numpy()
        if (side == 2).any():
            n, _, a, b = dual_links(unit(np.stack(v)), None, copies, copies, cosine)
            got, ends = (rep, n), (rep[a], rep[b])
        else:
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if not len(left) or not len(right):
                return pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
            n, m, a, b = dual_links(unit(np.stack(v[left])), unit(np.stack(v[right])), copies[left], copies[right], cosine)
            got, ends = (np.append(rep[left], rep[right]), np.append(n, m)), (rep[left][a], rep[right][b])
        counted = got[1] > 0
        return pd.DataFrame({
            "a": np.append(got[0][counted], ends[0]), "b": np.append(got[0][counted], ends[1]), "n": np.append(got[1][counted], np.zeros(len(ends[0]), np.int64)),
        })

    found = cut(units.groupBy(*CELL, "p", "q").applyInPandas(work, "a long, b long, n long"))
    counts = found.where("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    grouped = reps.select("rep", "low", "copies").join(components(found.where("n = 0").select("a", "b")), F.col("rep") == F.col("node"), "left")
    grouped = grouped.withColumn("c", F.coalesce("component", "rep")).drop("node", "component")
    lowest = grouped.groupBy("c").agg(F.min("low").alias("component_id"))
    known = grouped.join(lowest, "c").join(counts, "rep", "left").select("rep", "copies", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    keys = ["label", "dim", "h1", "h2"]
    named = cut(reps.select(*keys, "rep").join(known, "rep").select(*keys, "copies", "n_links", "component_id"))
    members = join_hot(rows.select("vec_id", *keys), named, keys, "copies").select("vec_id", "n_links", "component_id")
    alone = vectors.where(~can_link()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return members.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
