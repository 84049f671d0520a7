"""Language identification by cross-parsing entropy.

For each language, labelled text is turned into a suffix automaton, which accepts
exactly the text's substrings. A document is parsed from left to right into the
longest phrases that the labelled text holds (Ziv and Merhav, 1993); the phrases per
character, times the logarithm of the labelled text's length, estimate the cross
entropy. The language with the lowest estimate wins.

The automata are one table of transitions over all letters of the sample, dense where
it is small and a hash table of edges where the letters are many. Documents are cut
into blocks of ``BLOCK`` characters, each parsed from the start state, and all blocks
of a batch advance together, one character per step, against all languages at once.
Only letters are compared; whatever is between two words counts as one blank.

Each language also has a rate by chance, that of its own sample with the letters in
random order. A text of ``ENOUGH`` letters that parses no better than at ``CHANCE`` times that
rate of its best language is in none of the learned languages.

Training takes a bounded sample: ``ROWS_PER_LANGUAGE`` rows of each language by the
smallest hash of their id and text, the first ``ROW_CHARS`` characters of each, and of
those an equal part of ``CHARS_TOTAL`` characters for each language, but ``LEAST_CHARS``
at least. Every language is learned, and everything else covers all rows.

Defined cases: a null text, and one without a letter, is ``und`` with score 0; ties
go to the first language in alphabetical order; repeated rows and null ids each
return a row (a row without an id is in the training fold); rows with a null
language are not learned from; with no labelled text every document is ``und``; a
text of any length is parsed whole; other columns pass through ``predict``, in which
columns named as its results are replaced, and all columns through ``in_known_language``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.bytepair import LETTER, classes
from gleaner.llm.common import bounded_batches, fold, fresh_name, table
from gleaner.llm.hashmap import HashMap

ROWS_PER_LANGUAGE, ROW_CHARS, CHARS_TOTAL, LEAST_CHARS = 64, 4000, 80_000, 2000
BLOCK = 512
UNKNOWN = "und"
#: Cells of the largest dense table of transitions; larger ones are held as edges.
DENSE_CELLS = 24_000_000
MAX_BROADCAST_ROWS = 50_000
#: Of the rate by chance; and how many letters a text must have to be rejected by it.
CHANCE, ENOUGH = 1.0, 80


def suffix_automaton(text: np.ndarray) -> list[dict[int, int]]:
    """Transitions of each state; state 0 is the start."""
    link, length, follow = [-1], [0], [{}]
    last = 0
    for c in text.tolist():
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = new
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(follow)
                follow.append(dict(follow[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and follow[p].get(c) == q:
                    follow[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return follow


def letters_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts in one array, and how many are each
    text's; what is between letters, of whatever length, becomes one blank."""
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    sizes = np.array([len(t) for t in lowered], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    letter = classes()[points] == LETTER
    after_letter = np.append(False, letter[:-1] & (owner[1:] == owner[:-1])) if len(points) else letter
    kept = letter | after_letter
    points = np.where(letter, points, 32)[kept]
    return points, np.bincount(owner[kept], minlength=len(texts))


class Model:
    """Automata of all languages as sparse edges; the full table is made on use."""

    def __init__(self, samples: dict[str, str]) -> None:
        self.languages = sorted(samples)
        texts = [letters_of([samples[k]])[0] for k in self.languages]
        self.points = np.unique(np.concatenate([*texts, np.zeros(0, np.int64)]))
        self.width = len(self.points) + 2
        self.roots, self.bits, edges, at = [], [], [], 0
        for text in texts:
            follow = suffix_automaton(self.codes(text))
            edges += [(at + s, c, at + t) for s, x in enumerate(follow) for c, t in x.items()]
            self.roots.append(at)
            self.bits.append(float(np.log2(max(len(text), 2))))
            at += len(follow)
        self.states, self.edges, self.table = at, np.array(edges, np.int64).reshape(-1, 3), None
        rng = np.random.default_rng(5)
        self.chance = np.ones(len(self.languages))
        for k, text in enumerate(texts):
            mixed = "".join(map(chr, rng.permutation(text).tolist()))
            count, size = self.phrases([mixed])
            self.chance[k] = count[0, k] * self.bits[k] / max(size[0], 1) or 1
        self.table = None  # not broadcast, but made where it is used

    def codes(self, points: np.ndarray) -> np.ndarray:
        """0 pads, 1 is a character that no labelled text holds."""
        if not len(self.points):
            return np.ones(len(points), np.uint8)
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        return np.where(self.points[at] == points, at + 2, 1).astype(np.uint8 if self.width <= 256 else np.int32)

    def transitions(self):  # noqa: ANN201
        """By cell, a state's first one plus a code: twice the first cell of the next
        state, plus 1 if a phrase begins. An array, or where that would be large a function."""
        if self.table is None:
            self.table = self.dense() if self.states * self.width <= DENSE_CELLS else self.sparse()
        return self.table

    def dense(self) -> np.ndarray:
        to = np.full((self.states, self.width), -1, np.int32)
        to[self.edges[:, 0], self.edges[:, 1]] = self.edges[:, 2] * (2 * self.width)
        for root, end in zip(self.roots, [*self.roots[1:], self.states], strict=True):
            fresh = np.where(to[root] < 0, root * 2 * self.width, to[root]) + 1
            part = to[root:end]
            np.copyto(part, fresh, where=part < 0)  # a phrase begins where no longer one goes on
            part[0] = fresh
        to[:, 0] = np.arange(self.states, dtype=np.int32) * (2 * self.width)
        return to.ravel()

    def sparse(self):  # noqa: ANN201
        frm, code, to = self.edges.T
        inner = ~np.isin(frm, self.roots)
        cells, nexts = (frm * self.width + code)[inner], (to * (2 * self.width))[inner]
        found = HashMap(cells)
        fresh = np.repeat(np.array(self.roots, np.int64)[:, None] * 2 * self.width, self.width, axis=1)
        for k, root in enumerate(self.roots):
            own = frm == root
            fresh[k, code[own]] = to[own] * (2 * self.width)
        owner = np.searchsorted(self.roots, np.arange(self.states), side="right") - 1

        def move(cell: np.ndarray) -> np.ndarray:
            at = found.find(cell.ravel()).reshape(cell.shape)
            state, code = np.divmod(cell, self.width)
            begun = fresh[owner[state], code] + 1
            return np.where(code == 0, 2 * state * self.width, np.where(at >= 0, nexts[at], begun) if len(nexts) else begun)

        return move

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many phrases each text is parsed into, by text and language, and
        how many characters were parsed of each text."""
        moves, k = self.transitions(), len(self.languages)
        points, sizes = letters_of(texts)
        blocks = -(-sizes // BLOCK)
        codes = self.codes(points)
        grid = np.zeros((int(blocks.sum()), BLOCK), codes.dtype)
        within = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        grid.ravel()[within + np.repeat((np.cumsum(blocks) - blocks) * BLOCK, sizes)] = codes
        # the fullest blocks first, so that a step handles only those that go on
        lengths = np.concatenate([np.append(np.full(b - 1, BLOCK), s - (b - 1) * BLOCK) for b, s in zip(blocks.tolist(), sizes.tolist(), strict=True) if b] or [np.zeros(0, int)])
        order = np.argsort(-lengths, kind="stable")
        columns = np.ascontiguousarray(grid[order].T)
        going = np.searchsorted(-lengths[order], -np.arange(BLOCK), side="left")
        wide = np.int32 if isinstance(moves, np.ndarray) else np.int64
        state = np.repeat(np.array(self.roots, wide)[:, None] * self.width, len(grid), axis=1)
        count = np.zeros((k, len(grid)), np.int32)
        for step in range(BLOCK):
            n = going[step]
            if not n:
                break
            cell = state[:, :n] + columns[step, :n]
            move = moves[cell] if wide is np.int32 else moves(cell)
            count[:, :n] += move & 1
            state[:, :n] = move >> 1
        per_block = np.zeros((len(grid), k), np.int64)
        per_block[order] = count.T
        total = np.zeros((len(texts), k), np.int64)
        np.add.at(total, np.repeat(np.arange(len(texts)), blocks), per_block)
        return total, sizes

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The language of each text; a score from 0 to 1, how far the best estimate is
        below the second best, 0.5 for no difference; and whether the text is in that
        language, not in one that was not learned."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        count, sizes = self.phrases([t or "" for t in texts])
        known = sizes > 0  # what is parsed begins with a letter
        bits = count * np.array(self.bits) / np.maximum(sizes, 1)[:, None]
        best = bits.argmin(axis=1)
        low = np.sort(bits, axis=1)
        score = low[:, 1] / np.maximum(low[:, 0] + low[:, 1], 1e-9) if len(self.languages) > 1 else np.ones(len(texts))
        inside = known & ((sizes < ENOUGH) | (low[:, 0] < CHANCE * self.chance[best]))
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)], np.where(known, score, 0.0), inside


def fit(labelled: DataFrame) -> Model:
    """Learn from a bounded sample of ``labelled(doc_id, text, lang)``."""
    rows = labelled.where(F.col("lang").isNotNull() & (F.length("text") > 0))
    rows = rows.select("lang", F.substring("text", 1, ROW_CHARS).alias("text"), F.xxhash64("doc_id", "text").alias("h"))
    # the row of the smallest hash in each of ROWS_PER_LANGUAGE classes of hashes: only hashes are shuffled
    picked = rows.groupBy("lang", F.pmod("h", F.lit(ROWS_PER_LANGUAGE)).alias("slot")).agg(F.min("h").alias("h")).select("lang", "h")
    named = [r["lang"] for r in rows.select("lang").distinct().orderBy("lang").collect()]
    few = len(named) * ROWS_PER_LANGUAGE <= MAX_BROADCAST_ROWS  # hashes alone are broadcast
    found = rows.join(F.broadcast(picked) if few else picked, ["lang", "h"], "left_semi").dropDuplicates(["lang", "h"])
    room = max(CHARS_TOTAL // max(len(named), 1), LEAST_CHARS)
    # of each language the first rows by hash, as long as there is room
    before = F.sum(F.length("text") + 1).over(Window.partitionBy("lang").orderBy("h").rowsBetween(Window.unboundedPreceding, -1))
    taken = found.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < room).collect()
    samples = dict.fromkeys(named, "")
    for row in sorted(taken, key=lambda r: (r["lang"], r["before"])):
        samples[row["lang"]] = (samples[row["lang"]] + "\n" + row["text"])[:room]
    return Model(samples)


def predict(docs: DataFrame, model: Model, lang: str = "lang_pred", score: str = "score", inside: str | None = None) -> DataFrame:
    """``docs`` with the predicted language, its score and, if named, whether the text is
    in a learned language at all; only ``text`` is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang:string,score:double,inside:boolean>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for i in range(0, len(texts), 250):
                names, scores, known = shared.value.predict(texts.iloc[i : i + 250].tolist())
                out.append(pd.DataFrame({"lang": names, "score": scores, "inside": known}))
            yield pd.concat(out) if out else pd.DataFrame({"lang": [], "score": [], "inside": []})

    found = fresh_name(docs, "predicted")
    results = {lang: F.col(found)["lang"], score: F.col(found)["score"]} | ({inside: F.col(found)["inside"]} if inside else {})
    return docs.withColumn(found, udf("text")).withColumns(results).drop(found)


def held_out() -> F.Column:
    return fold(F.col("doc_id"), 4) == 2


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def in_known_language(docs: DataFrame) -> DataFrame:
    """``docs`` without those that are in none of the learned languages."""
    lang, score, inside = (fresh_name(docs, x) for x in ("lang_pred", "score", "inside"))
    return predict(docs, fit(docs.where(~held_out())), lang, score, inside).where(F.col(inside)).select(docs.columns)
