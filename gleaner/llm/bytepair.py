"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Code points become classes (letter, number, white space, other, and apostrophes by
the contraction that follows), and every class is a transition function over seven
states. Functions compose associatively, so token boundaries come from a scan:
blocks of a fixed length are composed side by side, the blocks' functions are
scanned by doubling, and each block is replayed from its entry state. No regular
expression is involved. The slices between boundaries feed merges by rank, cached
per worker. The byte offset where each id ends is kept with the ids: decoding lays the
ids' bytes out by them, all ids of a batch at once, and any span of ids alone.

Defined cases: a null or empty text has no ids and decodes to no bytes; texts of any
length and slices of any length are encoded whole (long slices by a heap of merges);
repeated rows and null ids each return a row; other columns are not read.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import bounded_batches, table

#: Symbols: letter, number, other, apostrophe before a contraction of one or two
#: letters, white space inside a run or at the text's end, the last white space of
#: a run before a visible character (not a blank, a blank), the start of a text.
LETTER, NUMBER, OTHER, SHORT, LONG, INSIDE, EDGE, BLANK, START = range(9)
#: States: a token must begin; inside letters, numbers, other marks or white space;
#: after the blank that begins a token; one or two letters of a contraction to go.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_SPACE, AFTER_BLANK, ONE_LEFT, TWO_LEFT = range(8)
#: The contractions of the public GPT-2 pattern (fixed values).
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
BLOCK = 64
CHUNK = 1 << 20
CACHED_SLICES = 200_000
NONE = np.int32(2**31 - 1)


def machine() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a token begins) by symbol and state."""
    follow, begins = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)
    run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHER}
    for symbol, state in run.items():
        follow[symbol] = state
        begins[symbol, [state, AFTER_BLANK]] = False
    follow[LETTER, [ONE_LEFT, TWO_LEFT]] = FRESH, ONE_LEFT
    begins[LETTER, [ONE_LEFT, TWO_LEFT]] = False
    for symbol, state in ((SHORT, ONE_LEFT), (LONG, TWO_LEFT)):
        follow[symbol] = state
        follow[symbol, [IN_OTHER, AFTER_BLANK]] = IN_OTHER
        begins[symbol, [IN_OTHER, AFTER_BLANK]] = False
    follow[INSIDE], begins[INSIDE, IN_SPACE] = IN_SPACE, False
    follow[EDGE], follow[BLANK], follow[START] = FRESH, AFTER_BLANK, FRESH
    return follow, begins


FOLLOW, BEGINS = machine()


@cache
def classes() -> np.ndarray:
    """The class of every code point: letter, number, white space (INSIDE) or other. The library itself is
    asked once in each worker, for its tables of Unicode are of another version than this Python's:
    an encoding whose pattern is a class drops all code points beyond it."""
    import tiktoken

    kinds = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    single = {bytes([b]): b for b in range(256)}
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", INSIDE)):
        asked = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        kinds[np.frombuffer(asked.decode(asked.encode_ordinary(every)).encode("utf-32-le"), np.uint32)] = kind
    return kinds


def symbols(points: np.ndarray) -> np.ndarray:
    """The machine's input; code point 0x10FFFF + 1 marks the start of a text."""
    start = points == 0x110000
    out = classes()[np.where(start, 0, points)]
    after = np.append(out[1:], START)
    out[start] = START
    after[np.flatnonzero(start)[1:] - 1] = START
    space = out == INSIDE
    last = space & (after != INSIDE) & (after != START)
    out[last] = EDGE
    out[last & (points == 0x20)] = BLANK
    quotes = np.flatnonzero(points == 0x27)
    if len(quotes):
        ahead = np.append(points, [0, 0])
        one, two = ahead[quotes + 1], ahead[quotes + 2]
        for c in CONTRACTIONS:
            hit = one == ord(c[0]) if len(c) == 1 else (one == ord(c[0])) & (two == ord(c[1]))
            out[quotes[hit]] = SHORT if len(c) == 1 else LONG
    return out


def boundaries(points: np.ndarray) -> np.ndarray:
    """Positions where tokens begin, and the starts of texts, by an associative scan."""
    n = len(points)
    sym = symbols(points)
    blocks = -(-n // BLOCK)
    grid = np.full(blocks * BLOCK, START, np.uint8)
    grid[:n] = sym
    grid = np.ascontiguousarray(grid.reshape(blocks, BLOCK).T)
    flat = FOLLOW.ravel()
    composed = np.tile(np.arange(8, dtype=np.uint8), (blocks, 1))
    for column in grid:  # every block's function, all blocks side by side
        composed = flat[(column.astype(np.int16)[:, None] << 3) + composed]
    step = 1
    while step < blocks:  # inclusive scan of the blocks' functions
        later = composed.copy()
        later[step:] = np.take_along_axis(composed[step:], composed[:-step], axis=1)
        composed = later
        step *= 2
    state = np.append(np.uint8(FRESH), composed[:-1, FRESH])
    begins = np.empty((BLOCK, blocks), bool)
    marks = BEGINS.ravel()
    for k, column in enumerate(grid):
        at = (column.astype(np.int16) << 3) + state
        begins[k] = marks[at]
        state = flat[at]
    return np.flatnonzero(begins.T.ravel()[:n])


class Codec:
    """Ranks of a vocabulary whose ids are the ranks, and what follows from them."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.bytes = {i: x for x, i in self.ranks.items()}
        self.sizes = np.zeros(max(self.bytes) + 1, np.int64)
        for i, x in self.bytes.items():
            self.sizes[i] = len(x)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.bytes.get(i, b"") for i in range(len(self.sizes))), np.uint8)
        self.cache: dict[str, bytes] = {}
        ranks = self.ranks
        pairs = sorted((ranks[x[:k]] << 32 | ranks[x[k:]], i) for x, i in ranks.items() for k in range(1, len(x)) if x[:k] in ranks and x[k:] in ranks)
        self.pairs, self.merged = np.array([p for p, _ in pairs] or [-1], np.int64), np.array([i for _, i in pairs] or [NONE], np.int32)
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int32)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair of ids merges to; NONE where it doesn't."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.merged[at], NONE)

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Int32 ids of each piece: in all pieces at once, the neighbours of lowest
        rank are merged, the leftmost first, until none is left."""
        out: list[bytes] = [b""] * len(pieces)
        groups: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if (whole := self.ranks.get(piece)) is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(piece) > 64:
                out[i] = np.array(self.merge_long(piece), "<i4").tobytes()
            else:
                groups.setdefault(-(-len(piece) // 8) * 8, []).append(i)
        for width, rows in groups.items():
            for lo in range(0, len(rows), 50_000):
                part = rows[lo : lo + 50_000]
                for i, ids in zip(part, self.merge_grid([pieces[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def merge_grid(self, pieces: list[bytes], width: int) -> list[bytes]:
        n = len(pieces)
        raw = np.frombuffer(b"".join([x.ljust(width + 2, b"\0") for x in pieces]), np.uint8).reshape(n, width + 2)
        inside = np.arange(width + 2) < np.array([len(x) for x in pieces])[:, None]
        ids = np.where(inside, self.single[raw], -1)  # two columns beyond the longest stay empty
        after = np.tile(np.arange(1, width + 3), (n, 1))
        before = np.tile(np.arange(-1, width + 1), (n, 1))
        rank = np.full((n, width + 2), NONE, np.int32)
        both = inside[:, 1:].nonzero()
        rank[both] = self.rank_of(ids[both], ids[both[0], both[1] + 1])
        rows = np.arange(n)
        while True:
            at = rank[rows].argmin(axis=1)
            low = rank[rows, at]
            live = low != NONE
            rows, at, low = rows[live], at[live], low[live]
            if not len(rows):
                break
            gone = after[rows, at]
            right, left = after[rows, gone], before[rows, at]
            ids[rows, at], ids[rows, gone] = low, -1
            rank[rows, gone] = NONE
            after[rows, at] = right
            before[rows, np.minimum(right, width + 1)] = at
            rank[rows, at] = np.where(ids[rows, np.minimum(right, width + 1)] >= 0, self.rank_of(low, np.maximum(ids[rows, np.minimum(right, width + 1)], 0)), NONE)
            has = left >= 0
            rank[rows[has], left[has]] = self.rank_of(ids[rows[has], left[has]], low[has])
        kept = ids >= 0
        flat, ends = ids[kept].astype("<i4").tobytes(), (4 * np.cumsum(kept.sum(axis=1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        ranks, n = self.ranks, len(piece)
        end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue
            alive[j], end[i], after[i] = False, stop, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := ranks.get(piece[i : end[after[i]]])) is not None:
                    heapq.heappush(heap, (r, i, end[after[i]]))
            if (k := before[i]) >= 0 and (r := ranks.get(piece[k:stop])) is not None:
                heapq.heappush(heap, (r, k, stop))
        return tuple(ranks[piece[i : end[i]]] for i in range(n) if alive[i])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit integers."""
        out: list[bytes] = []
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1]) + 1
            if size >= CHUNK:
                out += self.encode_group(group)
                group, size = [], 0
        return out + self.encode_group(group)

    def encode_group(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        mark = np.array([0x110000], np.uint32)
        points = np.concatenate([x for t in texts for x in (mark, np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32))])
        joined = "\0" + "\0".join(texts)
        starts = boundaries(points)
        at = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts])).tolist()
        starts = starts.tolist()
        slices = [joined[a:b] for a, b in zip(starts, [*starts[1:], len(joined)], strict=True)]
        known = self.cache
        if len(known) > CACHED_SLICES:
            known.clear()
        coded = list(map(known.get, slices))
        if None in coded:
            missing = list({piece for piece, ids in zip(slices, coded, strict=True) if ids is None})
            known.update(zip(missing, self.merge_many([x.encode("utf-8", "surrogatepass") for x in missing]), strict=True))
            coded = list(map(known.__getitem__, slices))
        return [b"".join(coded[a + 1 : b]) for a, b in zip(at, at[1:], strict=False)]  # without the marks

    def ends(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The byte offset in its text where each id ends; text k has ids bounds[k]..bounds[k+1]."""
        total = np.append(0, np.cumsum(self.sizes[ids]))
        return total[1:] - np.repeat(total[bounds[:-1]], np.diff(bounds))

    def decode(self, ids: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets): each text's bytes, one after another, and where they begin. An
        id's bytes lie before its end in its text."""
        filled = np.diff(bounds) > 0
        length = np.zeros(len(bounds) - 1, np.int64)
        length[filled] = ends[bounds[1:][filled] - 1]
        offsets = np.append(0, np.cumsum(length))
        size = self.sizes[ids]
        begin = np.repeat(offsets[:-1], np.diff(bounds)) + ends - size
        out = np.empty(int(offsets[-1]), np.uint8)
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(begin, size) + step] = self.flat[np.repeat(self.starts[ids], size) + step]
        return out, offsets


@cache
def codec(path: str) -> Codec:
    return Codec(path)


#: Texts that are encoded or decoded together.
TEXTS = 400


def decoded_array(coder: Codec, ids: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> pa.Array:
    raw, offsets = coder.decode(ids, ends, bounds)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).cast(pa.binary())


def encode(docs: DataFrame, vocabulary: str, decoded: bool = False) -> DataFrame:
    """(doc_id, ids array<int>, ends array<int>): the ids of ``docs(doc_id, text)``
    and the byte offset in the UTF-8 text where each one ends. With ``decoded`` also
    the bytes that those two decode to, in the same pass."""
    fields = [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))] + [("decoded", pa.binary())] * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(vocabulary)
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS):
                part = batch.slice(lo, TEXTS)
                coded = coder.encode(part.column(1).to_pylist())
                ids = np.frombuffer(b"".join(coded), "<i4")
                bounds = np.cumsum([0] + [len(x) // 4 for x in coded]).astype(np.int32)
                ends = coder.ends(ids, bounds)
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x.astype(np.int32))) for x in (ids, ends)]
                more = [decoded_array(coder, ids, ends, bounds)] if decoded else []
                yield pa.RecordBatch.from_arrays([part.column(0), *lists, *more], schema=pa.schema(fields))

    schema = "doc_id long, ids array<int>, ends array<int>" + ", decoded binary" * decoded
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def decode(coded: DataFrame, vocabulary: str) -> DataFrame:
    """``coded(doc_id, ids, ends)`` with ``decoded``, the bytes of its ids; null ids are none."""
    fields = [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("decoded", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(vocabulary)
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS):
                part = batch.slice(lo, TEXTS)
                lists = [part.column(k).fill_null([]) for k in (1, 2)]
                ids, ends = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists)
                bounds = np.append(0, np.cumsum([len(x) for x in lists[0]]))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(3)), decoded_array(coder, ids, ends, bounds)], schema=pa.schema(fields))

    return coded.select("doc_id", "ids", "ends").mapInArrow(run, "doc_id long, ids array<int>, ends array<int>, decoded binary")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    path = vocabulary_path()
    coded = encode(table(spark, sf_dir, "documents"), path, decoded=True)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
