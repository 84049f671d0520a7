"""Packing by deficit round-robin over source queues.

Every source is a queue of its documents' tokens, in the order of ``doc_id``. Each
sequence is filled by one round: a queue's quantum is its target share of the
sequence; its deficit grows by the quantum, whole tokens are served, the fraction is
carried on. That order is the one of due times: a queue's k-th token is due at
k / weight, and the earliest due token of all queues comes next. The deficits at the
start of any sequence therefore follow from its number alone, so they are carried
across partitions without running the partitions one after another, and documents
are cut where a queue's share of a sequence ends. The last tokens, fewer than a
sequence, are cut into sequences of powers of two, which need no padding.

The target shares are ``weights`` by source (others have ``OTHER_WEIGHT``); without
them every queue has its share of all tokens, so that all run out together. A queue
that runs out leaves its room to the others, by their weights.

Texts are tokenised once; their ids, as narrow integers, are written to the shared
checkpoint folder, counted there, and shuffled once to the place where they are cut.

Defined cases: a null text is empty and has only the end token; a null source is a
queue of its own; rows that repeat an id, or have none, are packed like others, the
latter first in their queue; ties are ordered by the text's hash; an empty table
gives no rows; any text length works. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import bases, bounded_batches, cut, ordered_buckets, table
from gleaner.llm.hashmap import HashMap

SEQUENCE = 4096
END = 2
MAX_QUEUES = 4096
OTHER_WEIGHT = 1.0
ROWS_PER_BUCKET = 512
#: Texts that are tokenised together, and texts that are cut together.
TEXTS, ROWS = 512, 256
#: Sequences times queues that are looked at together.
CELLS = 1 << 18
#: Pieces of each generation of a worker's table, and code points that are looked up together.
CACHED, CHUNK = 1_000_000, 1 << 18
BREAK = re.compile("[\t\n\x0b\x0c\r ]")
#: The normaliser and splitter (fixed values) of the vocabulary whose words can be told apart beforehand.
NORMALISERS = ["NFC", "Replace", "Lowercase"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
#: Kinds of code points: the white space that separates words; Latin letters, which NFC
#: keeps and which are lowered one by one; ASCII marks but the apostrophe; all others.
SPACE, LETTER, MARK, OTHER = range(4)
#: Longer pieces are hashed as a whole.
LONG = 64
SPREAD = np.uint64(0xFF51AFD7ED558CCD)
POWERS = np.cumprod(np.append(np.uint64(1), np.full(LONG - 1, 0x9E3779B97F4A7C15, np.uint64)))
MORE_POWERS = np.cumprod(np.append(np.uint64(1), np.full(LONG - 1, 0xD6E8FEB86659FD93, np.uint64)))


@cache
def kinds() -> tuple[np.ndarray, np.ndarray]:
    """By code point: its kind, and its lower case if it is a letter."""
    kind = np.full(0x110000, OTHER, np.uint8)
    low = np.arange(0x110000, dtype=np.uint32)
    for first, last in (("A", "Z"), ("\xc0", "\xd6"), ("\xd8", "\xde")):
        low[ord(first) : ord(last) + 1] += 32
        kind[ord(first) : ord(last) + 1] = kind[ord(first) + 32 : ord(last) + 33] = LETTER
    kind[[0xDF, 0xFF]] = LETTER
    for first, last in (("!", "&"), ("(", "/"), (":", "@"), ("[", "`"), ("{", "~")):
        kind[ord(first) : ord(last) + 1] = MARK
    kind[[9, 10, 11, 12, 13, 32]] = SPACE
    return kind, low


class Known:
    """Ids of pieces of text, by 128-bit hashes; when full, a generation begins."""

    def __init__(self, most: int, kind: str) -> None:
        self.most, self.n = most, 0
        self.map = HashMap(np.zeros(0, np.int64), most)
        self.check, self.start, self.count = np.zeros(most, np.int64), np.zeros(most, np.int64), np.zeros(most, np.int64)
        self.ids, self.used = np.zeros(4 * most, kind), 0

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        at = self.map.find(keys)
        return np.where((at >= 0) & (self.check[at] == checks), at, -1)

    def add(self, keys: np.ndarray, checks: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> np.ndarray:
        places = np.arange(self.n, self.n + len(keys))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        self.ids[self.used : self.used + len(ids)] = ids
        self.check[places], self.count[places] = checks, counts
        self.start[places] = self.used + np.cumsum(counts) - counts
        self.map.insert(keys, places.astype(np.int32))
        self.n, self.used = self.n + len(keys), self.used + len(ids)
        return places


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... counts[0] numbers, and so on for each start."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


class WordTokenizer:
    """Token ids of whole texts, piece by piece: the tokenizer drops white space and
    no merge crosses it, so equal words have equal ids. Of a word of Latin letters and
    marks alone, each run of letters or of marks is a piece, whose merges need no
    normalising or splitting; any other word, and one that holds an added token of the vocabulary, is a piece whole. Pieces are found and
    hashed in arrays, and their ids kept in two generations of ``most`` pieces each: what
    is looked up in the old one comes back to the young one, so pieces in use stay.
    A vocabulary with another normaliser or splitter encodes whole texts."""

    def __init__(self, path: str, most: int = CACHED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.inner = Tokenizer.from_file(path)
        size = self.inner.get_vocab_size()
        self.type = "<u2" if size <= 1 << 16 else "<u4"
        self.letter = "H" if self.type == "<u2" else "I"
        spec = json.loads(self.inner.to_str())
        self.added = [x["content"] for x in spec["added_tokens"]]
        self.by_words = splits_into_words(spec)
        if self.by_words:
            # one tokenizer, whose normaliser and splitter are set for what it is to encode
            self.whole = (self.inner.normalizer, self.inner.pre_tokenizer)
            self.piecewise = (None, pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)]))
            self.ends = np.zeros(size, bool)
            for piece, i in self.inner.get_vocab().items():
                self.ends[i] = piece.endswith(WORD_END)
            self.young, self.old = Known(most, self.type), Known(1, self.type)

    def narrow(self, coded: list) -> list[bytes]:
        return [array(self.letter, x.ids).tobytes() for x in coded]

    def learn(self, runs: list[str], words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(how many, ids) of runs of letters or marks, many in one call, told apart in
        the result by the ids that end a piece; then of whole words."""
        lines = [" ".join(runs[k : k + 1000]) for k in range(0, len(runs), 1000)]
        self.inner.normalizer, self.inner.pre_tokenizer = self.piecewise
        raw = b"".join(self.narrow(self.inner.encode_batch_fast(lines, add_special_tokens=False)))
        self.inner.normalizer, self.inner.pre_tokenizer = self.whole
        ids = np.frombuffer(raw, self.type)
        counts = np.diff(np.append(-1, np.flatnonzero(self.ends[ids])))
        more = self.narrow(self.inner.encode_batch_fast(words, add_special_tokens=False))
        own = np.array([len(x) // ids.itemsize for x in more], np.int64)
        return np.append(counts, own), np.append(ids, np.frombuffer(b"".join(more), self.type))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian integers of ``type``."""
        if not self.by_words:
            return self.narrow(self.inner.encode_batch_fast([t or "" for t in texts], add_special_tokens=False))
        out: list[bytes] = []
        group: list[str] = []
        size = 0
        for text in texts:
            text = text or ""
            if len(text) > CHUNK:  # alone, in parts that end with a word
                out += self.encode_group(group)
                group, size, at, parts = [], 0, 0, []
                while at < len(text):
                    end = BREAK.search(text, at + CHUNK)
                    end = end.end() if end else len(text)
                    parts += self.encode_group([text[at:end]])
                    at = end
                out.append(b"".join(parts))
                continue
            group.append(text)
            size += len(text)
            if size >= CHUNK:
                out += self.encode_group(group)
                group, size = [], 0
        return out + self.encode_group(group)

    def encode_group(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        kind, low = kinds()
        joined = "\n".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        of = kind[points]
        for token in self.added:  # a word with one is encoded whole
            at = joined.find(token)
            while at >= 0:
                of[at] = OTHER
                at = joined.find(token, at + len(token))
        inside = of != SPACE
        first = inside & ~np.append(False, inside[:-1])
        words = np.flatnonzero(first)
        if not len(words):
            return [b""] * len(texts)
        whole = np.maximum.reduceat(of, words) == OTHER
        sizes = np.diff(np.append(words, len(of)))
        of = np.where(np.repeat(whole, sizes) & inside[words[0] :], OTHER, of[words[0] :])  # from the first word on
        points, inside, first = points[words[0] :], inside[words[0] :], first[words[0] :]
        points = np.where(of == LETTER, low[points], points)
        starts = np.flatnonzero(inside & (first | (of != np.append(SPACE, of[:-1]))))
        after = np.append(np.flatnonzero(~inside), len(of))
        ends = np.minimum(np.append(starts[1:], len(of)), after[np.searchsorted(after, starts)])
        keys, checks = self.hashes(points, inside, starts, ends)
        at = self.places(points, of, starts, ends, keys, checks)
        count = self.young.count[at]
        ids = self.young.ids[spread(self.young.start[at], count)].tobytes()
        bounds = np.cumsum([0] + [len(t) + 1 for t in texts]) - words[0]
        total = np.append(0, np.cumsum(count)) * np.dtype(self.type).itemsize
        cut = total[np.searchsorted(starts, bounds)].tolist()
        return [ids[a:b] for a, b in zip(cut, cut[1:], strict=False)]

    def hashes(self, points: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each piece."""
        value = (points.astype(np.uint64) + np.uint64(1)) * SPREAD
        value = np.where(inside, value ^ (value >> np.uint64(32)), 0)  # a number for each code point
        place = np.minimum(np.arange(len(points)) - np.repeat(starts, np.diff(np.append(starts, len(points)))), LONG - 1)
        keys, checks = (np.add.reduceat(value * powers[place], starts) for powers in (POWERS, MORE_POWERS))
        size = (ends - starts).astype(np.uint64)
        keys, checks = keys ^ (keys >> np.uint64(31)), checks + size
        for i in np.flatnonzero(size > LONG).tolist():
            digest = hashlib.blake2b(points[starts[i] : ends[i]].tobytes(), digest_size=16).digest()
            keys[i], checks[i] = np.frombuffer(digest, np.uint64)
        keys[keys == np.uint64(2**64 - 1)] = 0  # what the map takes for an empty slot
        return keys.view(np.int64), checks.view(np.int64)

    def places(self, points: np.ndarray, of: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Where each piece is in the young generation, once all are there."""
        most = self.young.most
        if self.young.n + len(starts) > most:
            self.old, self.young = self.young, Known(max(most, len(starts)), self.type)
        at = self.young.find(keys, checks)
        missing = np.flatnonzero(at < 0)
        if not len(missing):
            return at
        _, one = np.unique(keys[missing], return_index=True)
        one = missing[one]
        back = self.old.find(keys[one], checks[one])
        again, fresh = one[back >= 0], one[back < 0]
        if len(again):
            back = back[back >= 0]
            count = self.old.count[back]
            self.young.add(keys[again], checks[again], count, self.old.ids[spread(self.old.start[back], count)])
        if len(fresh):
            text = points.tobytes().decode("utf-32-le", "surrogatepass")
            alone = of[starts[fresh]] == OTHER
            fresh = np.append(fresh[~alone], fresh[alone])
            pieces = [text[a:b] for a, b in zip(starts[fresh].tolist(), ends[fresh].tolist(), strict=True)]
            runs = len(fresh) - int(alone.sum())
            self.young.add(keys[fresh], checks[fresh], *self.learn(pieces[:runs], pieces[runs:]))
        at[missing] = self.young.find(keys[missing], checks[missing])
        return at


def splits_into_words(spec: dict) -> bool:
    """Whether a tokenizer drops white space, lowers case, ends each word with its own pieces, and finds its added
    tokens inside words, as they stand."""
    inside = all(not (x["normalized"] or x["single_word"] or x["lstrip"] or x["rstrip"]) and len(x["content"].split()) == 1 for x in spec["added_tokens"])
    normalisers = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
    first = next(iter((spec["pre_tokenizer"] or {}).get("pretokenizers", [])), {})
    return inside and normalisers == NORMALISERS and first.get("pattern") == {"Regex": SPLIT} and first.get("invert") is True and spec["model"].get("end_of_word_suffix") == WORD_END


@cache
def tokenizer(path: str, most: int = CACHED) -> WordTokenizer:
    return WordTokenizer(path, most)


class Plan:
    """Where the tokens of each queue go, from the queues' totals and weights alone."""

    def __init__(self, totals: list[int], sequence: int = SEQUENCE, weights: list[float] | None = None) -> None:
        self.totals, self.sequence = np.array(totals, np.int64), sequence
        self.weights = np.maximum(self.totals, 1) / max(int(self.totals.max(initial=0)), 1) if weights is None else np.array(weights, np.float64)
        self.n = int(self.totals.sum())
        self.full = self.n // sequence
        tail = self.n - self.full * sequence
        self.tail = []  # sizes of the last sequences, powers of two
        for bit in range(sequence.bit_length(), -1, -1):
            if tail >> bit & 1:
                self.tail.append(1 << bit)
        self.last = self.full + len(self.tail)
        # the time when each queue runs out, and the tokens that are packed by then
        self.out = np.unique(self.totals / self.weights)
        self.by_then = np.array([np.minimum(self.totals, self.weights * x).sum() for x in self.out])

    def time(self, tokens: np.ndarray) -> np.ndarray:
        """When so many tokens are packed."""
        return np.interp(tokens, np.append(0, self.by_then), np.append(0, self.out))

    def served(self, tokens: np.ndarray) -> np.ndarray:
        """How many tokens each queue has handed over when ``tokens`` are packed: those
        of the earliest due times, the first queue's of equal ones."""
        queues = len(self.totals)
        base = np.minimum(np.maximum(np.floor(self.time(tokens)[:, None] * self.weights) - 1, 0), self.totals).astype(np.int64)
        rest = tokens - base.sum(axis=1)
        k = base[:, :, None] + np.arange(1, 4)  # the next tokens of each queue, side by side
        due = np.where(k <= self.totals[:, None], k / self.weights[:, None], np.inf).reshape(len(tokens), 3 * queues)
        order = np.argsort(due, axis=1, kind="stable")
        row, at = np.nonzero(np.arange(3 * queues) < rest[:, None])
        np.add.at(base, (row, order[row, at] // 3), 1)
        return base

    def start(self, numbers: np.ndarray) -> np.ndarray:
        """Tokens packed before each of these sequences."""
        over = np.concatenate([[0], np.cumsum(self.tail)]).astype(np.int64)
        return np.minimum(numbers, self.full) * self.sequence + over[np.clip(numbers - self.full, 0, len(self.tail))]

    def pieces(self, queue: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, from, to, sequence, offset) for rows that hold tokens lo..hi of a queue."""
        queues = len(self.totals)
        wanted = lambda k: np.interp(k / self.weights[queue], np.append(0, self.out), np.append(0, self.by_then))
        slack = 2 * queues + 2
        first = np.maximum(0, np.floor((wanted(lo) - slack) / self.sequence).astype(np.int64) - 1)
        after = np.floor((wanted(hi) + slack) / self.sequence).astype(np.int64) + 2
        first, after = np.minimum(first, self.full), np.where(after >= self.full, self.last, after)
        count = after - first
        if int(count.sum()) * queues > CELLS and (len(queue) > 1 or hi[0] - lo[0] > 1):
            if len(queue) > 1:  # the rows, or the tokens of one row, in two halves
                k = len(queue) // 2
                a, b = self.pieces(queue[:k], lo[:k], hi[:k]), self.pieces(queue[k:], lo[k:], hi[k:])
                b = (b[0] + k, *b[1:])
            else:
                middle = (lo + hi) // 2
                a, b = self.pieces(queue, lo, middle), self.pieces(queue, middle, hi)
            return tuple(np.concatenate(x) for x in zip(a, b, strict=True))
        row = np.repeat(np.arange(len(queue)), count)
        number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
        bounds, place = np.unique(np.concatenate([number, number + 1]), return_inverse=True)
        handed = self.served(self.start(bounds))
        a, b, q = place[: len(number)], place[len(number) :], queue[row]
        begin, end = handed[a, q], handed[b, q]
        frm, to = np.maximum(lo[row], begin), np.minimum(hi[row], end)
        used = np.flatnonzero(to > frm)
        before = np.cumsum(handed, axis=1) - handed  # tokens of the queues before, up to each sequence
        offset = before[b, q] - before[a, q] + frm - begin
        return row[used], frm[used], to[used], number[used], offset[used]


PIECES = "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def queue_of(sources: int, limit: int = MAX_QUEUES) -> F.Column:
    """A source's queue; beyond ``limit`` sources, sources share queues by hash."""
    named = F.concat(F.lit("s"), F.coalesce("source", F.lit("")), F.when(F.col("source").isNull(), "0").otherwise("1"))
    return named if sources <= limit else F.pmod(F.xxhash64(named), F.lit(limit)).cast("string")


def pack(docs: DataFrame, vocabulary: str, sequence: int = SEQUENCE, end: int = END, cached: int = CACHED, weights: dict[str, float] | None = None) -> DataFrame:
    """One row per piece of ``docs(doc_id, text, source)``; every token is in one piece.
    ``cached`` bounds a worker's table of pieces; a smaller one takes less memory and more
    time. ``weights`` are the target shares of sources, in any unit, each above 0."""
    docs = docs.select("doc_id", "text", "source").withColumn("tie", F.xxhash64("text"))
    sources = docs.agg(F.approx_count_distinct("source")).first()[0] + 1
    if weights and sources > MAX_QUEUES:
        raise ValueError(f"weights need at most {MAX_QUEUES} sources, one queue each")
    docs = docs.withColumns({"queue": queue_of(sources), "bucket": ordered_buckets(docs, "doc_id", "tie", ROWS_PER_BUCKET)})
    kind = "<u2" if tokenizer(vocabulary).type == "<u2" else "<u4"
    wide = int(kind[-1])

    def tokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, stop = tokenizer(vocabulary, cached), np.array([end], kind).tobytes()
        for batch in batches:
            for i in range(0, len(batch), TEXTS):
                part = batch.iloc[i : i + TEXTS]
                ids = [x + stop for x in coder.encode(part.pop("text").tolist())]
                yield part.assign(n=np.array([len(x) // wide for x in ids], np.int64), ids=ids)

    columns = ["doc_id", "source", "queue", "bucket", "tie"]
    tokens = cut(docs.select(*columns, "text").mapInPandas(tokenise, "doc_id long, source string, queue string, bucket long, tie long, n long, ids binary"))
    sums = cut(tokens.groupBy("queue", "bucket").agg(F.sum("n").alias("n")))
    rows = sums.groupBy("queue").agg(F.sum("n").alias("n")).collect()  # at most MAX_QUEUES rows
    rows = sorted((r["queue"], r["n"]) for r in rows)
    names = {q: i for i, (q, _) in enumerate(rows)}
    shares = [weights.get(q[1:-1] if q[-1] == "1" else None, OTHER_WEIGHT) for q, _ in rows] if weights else None
    plan = Plan([n for _, n in rows], sequence, shares)
    base = bases(sums, "queue", "bucket", "n").select("queue", "bucket", "base")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, at = None, 0
        for batch in batches:
            n = batch["n"].to_numpy()
            lo = np.zeros(len(batch), np.int64)
            for k, (q, b, first) in enumerate(zip(batch["queue"], batch["bucket"], batch["base"], strict=True)):
                if (q, b) != group:
                    group, at = (q, b), first
                lo[k] = at
                at += n[k]
            queue = batch["queue"].map(names).to_numpy(np.int64)
            for i in range(0, len(batch), ROWS):
                ids = [np.frombuffer(x, kind).astype("<u4").tobytes() for x in batch["ids"].iloc[i : i + ROWS]]
                first = lo[i : i + ROWS]
                row, frm, to, number, offset = plan.pieces(queue[i : i + ROWS], first, first + n[i : i + ROWS])
                frm, to = frm - first[row], to - first[row]
                crc = [zlib.crc32(ids[r][4 * a : 4 * b]) for r, a, b in zip(row.tolist(), frm.tolist(), to.tolist(), strict=True)]
                row += i
                yield pd.DataFrame({"doc_id": batch["doc_id"].array.take(row), "source": batch["source"].array.take(row), "start": frm, "length": to - frm, "ids_crc32": np.array(crc, np.int64), "doc_tokens": n[row], "sequence_id": number, "offset": offset})

    placed = tokens.repartition("queue", "bucket").join(base, ["queue", "bucket"])
    ordered = placed.sortWithinPartitions("queue", "bucket", F.asc_nulls_first("doc_id"), "tie")
    return ordered.select(*columns, "n", "ids", "base").mapInPandas(write, PIECES)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return pack(table(spark, sf_dir, "documents"), vocabulary_path())
