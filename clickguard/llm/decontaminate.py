"""Benchmark items inside documents: SimHash of item-sized windows, a
multi-index over Hamming blocks, exact weighted-shingle similarity.

Texts are lower-cased (A-Z), split at white space and read as shingles of
`SHINGLE` words. An item of W words is looked up by windows of its size class c
(the largest of 5, 6, 7, ... growing by a fifth, at most `LARGEST`, with room
for a step); its own windows of c words at the first offsets are indexed, one
for each remainder of the step. Every document is covered by windows of c words
at a step of c/8 words, so some window meets an indexed one word for word
wherever a copy starts. An item of more than `LARGEST` words has such sets of
windows all over it, every c words and at its end, of a class that at least
three fit side by side: a change at one place leaves one of them whole.
A window's fingerprint has bit i where more than half of its shingle hashes do.
Two fingerprints within `RADIUS` = 15 bits agree to 3 bits in at least one of
four 16-bit blocks (4 x 4 would be 16): per block, a table from each of the
65,536 values to the items within 3 bits finds all of them.

Survivors are verified by sum(min) / sum(max) of the shingles' multiplicities
over the item and the passage of W words, at the best of the starts that the
step leaves open.

One pass over the documents and no shuffle. Bit counts of all windows come
from one running sum with eight 8-bit lanes a word: window sums stay below 256,
so differences of the wrapped sums are exact. The index has a bound: items are
taken in blocks of about `ITEMS`, fewer where they are long (about
`ITEMS` * `SET` windows, but at least one item), a block against all documents.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clickguard.llm.common import fresh, map_texts, ragged, slabs, stored
from clickguard.llm.words import WordHasher

SHINGLE = 5
LARGEST = 256
BLOCKS, BLOCK_BITS, PER_BLOCK = 4, 16, 3
RADIUS = BLOCKS * (PER_BLOCK + 1) - 1
ITEMS = 500
SET = 27  # windows of an item of the largest class
_SLAB = 1 << 20
_WINDOWS = 1 << 15  # looked up at a time
#: Words of a text searched at a time, besides the overlap.
SEGMENT = 1 << 17

_U = np.uint64
_ONES, _HIGH, _PICK = _U(0x0101010101010101), _U(0x8080808080808080), _U(0x0102040810204080)
_LANES = np.array([sum(((v >> i) & 1) << (8 * i) for i in range(8)) for v in range(256)], _U)
_MIX = np.array([xxhash.xxh64_intdigest(bytes([i]), 5) | 1 for i in range(SHINGLE + 1)], _U)


def shingles(w: np.ndarray) -> np.ndarray:
    """Hashes of the SHINGLE-word shingles of a sequence of word hashes."""
    n = max(0, len(w) - SHINGLE + 1)
    s = np.zeros(n, _U)
    for j in range(SHINGLE):
        s += w[j:j + n] * _MIX[j]
    s = (s ^ (s >> _U(32))) * _MIX[SHINGLE]
    return s ^ (s >> _U(29))


def running(s: np.ndarray) -> np.ndarray:
    """Running bit counts: row k has those of the first k shingles."""
    out = np.zeros((len(s) + 1, 8), _U)
    np.cumsum(_LANES[np.ascontiguousarray(s).view(np.uint8).reshape(-1, 8)], axis=0, out=out[1:])
    return out


def fingerprints(total: np.ndarray, start: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Of the m shingles (1 to 255) from each start."""
    add = ((127 - m // 2).astype(_U) * _ONES)[:, None]
    x = (total[start + m] - total[start] + add) & _HIGH
    return (((x >> _U(7)) * _PICK) >> _U(56)).astype(np.uint8).view(_U).ravel()


def step(c: int) -> int:
    """Words between the windows of a class."""
    return max(1, c // 8)


def size_class(words: int) -> int:
    """The largest class of which an item has a window for each remainder of
    the step: then some window of a copy is one of the item's own."""
    c = SHINGLE
    while (up := max(c + 1, c * 6 // 5)) + step(up) - 1 <= words and up <= LARGEST:
        c = up
    return c


def placed(words: int) -> tuple[int, np.ndarray]:
    """The class of an item and where its indexed windows start."""
    if words <= LARGEST:
        c = size_class(words)
        return c, np.arange(min(words - c + 1, step(c)))
    c = size_class(words // 3)
    last = words - c - step(c) + 1
    sets = np.r_[np.arange(0, last, c), last]
    return c, np.unique(sets[:, None] + np.arange(step(c)))


class Index:
    """The items of one block of the benchmark, by size class."""

    def __init__(self, items: list[tuple[object, str | None]]):
        self.ids, self.size, self.bags, found = [], [], [], {}
        hashes = WordHasher()([text for _, text in items])
        for (ident, _), w in zip(items, hashes):
            if len(w) < SHINGLE:
                continue
            s, (c, off) = shingles(w), placed(len(w))
            fp = fingerprints(running(s), off, np.full(len(off), c - SHINGLE + 1))
            found.setdefault(c, []).append((fp, np.full(len(off), len(self.ids)), off))
            self.ids.append(ident)
            self.size.append(len(w))
            self.bags.append(Counter(s.tolist()))
        self.size = np.array(self.size, np.int64)
        flips = np.array([sum(1 << i for i in c) for k in range(PER_BLOCK + 1)
                          for c in combinations(range(BLOCK_BITS), k)])
        self.classes = {}
        for c, parts in found.items():
            fp, item, off = (np.concatenate(x) for x in zip(*parts))
            tables = []
            for b in range(BLOCKS):
                v = (fp >> _U(BLOCK_BITS * b)).astype(np.int64) & 0xFFFF
                near = (v[:, None] ^ flips).ravel()
                order = np.argsort(near, kind="stable")
                at = np.searchsorted(near[order], np.arange((1 << BLOCK_BITS) + 1))
                tables.append((at, (order // len(flips)).astype(np.int32)))
            self.classes[c] = fp, item, off, tables
        known = np.array(sorted(set().union(*self.bags)), _U) if self.bags else np.zeros(0, _U)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(known >> _U(44)).astype(np.int64)] = True

    def lookup(self, c: int, fp: np.ndarray):
        """(row of fp, number of the indexed window) of all pairs in RADIUS."""
        mine, _, _, tables = self.classes[c]
        rows, hits = [], []
        for b, (at, of) in enumerate(tables):
            v = (fp >> _U(BLOCK_BITS * b)).astype(np.int64) & 0xFFFF
            n = at[v + 1] - at[v]
            w = np.repeat(np.arange(len(fp)), n)
            k = of[ragged(at[v], n)]
            ok = np.bitwise_count(fp[w] ^ mine[k]) <= RADIUS
            rows.append(w[ok])
            hits.append(k[ok])
        return np.concatenate(rows), np.concatenate(hits)


def similarity(a: Counter, b: Counter) -> float:
    most = sum((a | b).values())
    return sum((a & b).values()) / most if most else 0.0


def search(index: Index, words: list[np.ndarray], least: float):
    """{(text, item): (similarity, first word)} over the texts of a slab; a
    long text in segments that overlap by more than the longest item."""
    over = int(index.size.max(initial=0)) + LARGEST
    best: dict = {}
    parts, where, size = [], [], 0

    def flush():
        for (k, i), (sim, a) in _search(index, parts, least).items():
            t, base = where[k]
            best[t, i] = min(best.get((t, i), (0.0, 0)), (-sim, a + base))

    for t, w in enumerate(words):
        for base in range(0, max(len(w), 1), SEGMENT):
            if size > SEGMENT:
                flush()
                parts, where, size = [], [], 0
            parts.append(w[base:base + SEGMENT + over])
            where.append((t, base))
            size += len(parts[-1])
    flush()
    return {k: (-s, a) for k, (s, a) in best.items()}


def _search(index: Index, words: list[np.ndarray], least: float):
    n = np.array([len(w) for w in words], np.int64)
    w = np.concatenate(words) if words else np.zeros(0, _U)
    s = shingles(w)
    if not len(s):
        return {}
    end = np.cumsum(n)
    begin = end - n
    total = running(s)
    shared = np.r_[0, np.cumsum(index.seen[(s >> _U(44)).astype(np.int64)])]
    text = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(w)) - begin[text]
    todo = set()
    for c, (_, item, off, _) in index.classes.items():
        near = step(c)
        whole = np.flatnonzero((place % near == 0) & (place + c <= n[text]))
        short = np.flatnonzero((n < c) & (n >= SHINGLE))
        start = np.r_[whole, begin[short]]
        m = np.r_[np.full(len(whole), c - SHINGLE + 1), n[short] - SHINGLE + 1]
        for lo in range(0, len(start), _WINDOWS):
            p, k = start[lo:lo + _WINDOWS], m[lo:lo + _WINDOWS]
            row, hit = index.lookup(c, fingerprints(total, p, k))
            at, size = p[row] - off[hit], index.size[item[hit]]
            t = text[p[row]]
            # shingles of the item that the passage can have, at any start
            a = np.maximum(at - near, begin[t])
            z = np.minimum(at + near + size, end[t]) - SHINGLE + 1
            ok = shared[np.maximum(z, a)] - shared[a] >= least * (size - SHINGLE + 1)
            todo.update(zip(t[ok].tolist(), item[hit][ok].tolist(),
                            (at - begin[t])[ok].tolist(), np.full(ok.sum(), near).tolist()))
    best: dict = {}
    starts: dict = {}
    for t, i, at, near in todo:
        starts.setdefault((t, i), set()).update(range(at - near, at + near + 1))
    for (t, i), places in starts.items():
        mine, w0 = s[begin[t]:end[t] - SHINGLE + 1], index.size[i]
        for a in places:
            sim = similarity(Counter(mine[max(a, 0):max(a + w0 - SHINGLE + 1, 0)].tolist()), index.bags[i])
            if sim >= least:
                old = best.get((t, i))
                best[t, i] = min(old, (-sim, max(a, 0))) if old else (-sim, max(a, 0))
    return {k: (-s, a) for k, (s, a) in best.items()}


def _indexes(benchmark: DataFrame, item_col: str, item_text: str):
    """The benchmark in blocks, an index each; none of an empty table."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).cast("string").alias("text"))
    n_words = F.size(F.split("text", r"[ \t-\r]+"))
    windows = F.when(n_words > LARGEST, n_words / 8 + 2 * SET).otherwise(SET)
    n, weight = items.agg(F.count("*"), F.coalesce(F.sum(windows), F.lit(0.0))).first()
    blocks = max(-(-n // ITEMS), int(-(-weight // (ITEMS * SET))))
    for k in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        yield blocks, Index([tuple(r) for r in mine.collect()])


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text", least: float = 0.8) -> DataFrame:
    """(`id_col`, `item_col`, similarity, word_start, n_words): per row of
    `docs` and item that it holds, the most similar passage (the first of
    several). Items of fewer than five words match nothing, nor do null or empty
    texts; repeated rows and items give repeated results; null ids stay null, ids
    of items keep their type; an empty table on either side gives an empty
    result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    item_kind = benchmark.schema[item_col].dataType
    schema = (f"id {rows.schema['id'].dataType.simpleString()}, item {item_kind.simpleString()}, "
              "similarity double, word_start long, n_words int")
    item_type = to_arrow_type(item_kind)
    found = None
    for blocks, index in _indexes(benchmark, item_col, item_text):

        def run(batches, ix=index):  # Spark sends a large function as a broadcast
            hasher = WordHasher()
            for b in slabs(batches, "text", _SLAB):
                best = search(ix, hasher(b.column("text").to_pylist()), least)
                if best:
                    key = sorted(best)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("id").take(pa.array([t for t, _ in key])),
                         pa.array([ix.ids[i] for _, i in key], item_type),
                         pa.array([best[x][0] for x in key], pa.float64()),
                         pa.array([best[x][1] for x in key], pa.int64()),
                         pa.array([int(ix.size[i]) for _, i in key], pa.int32())],
                        ["id", "item", "similarity", "word_start", "n_words"])

        part = map_texts(rows, run, schema)
        if blocks > 1:  # an index at a time in the executors' memory
            part = stored(part, "leaks")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    out = ["similarity", "word_start", "n_words"]
    return found.select(F.col("id").alias(id_col),
                        F.col("item").alias(fresh(item_col, [id_col])),
                        *[F.col(c).alias(fresh(c, [id_col, item_col])) for c in out])


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", least: float = 0.8) -> DataFrame:
    """`docs` without the rows whose text holds an item of the benchmark, as
    `leaks` finds it. Every row is judged where it is read: nothing is shuffled,
    and rows that share an id, or have none, do not decide for each other. Rows
    with null or empty texts stay, all columns stay as they are, and an empty
    benchmark takes nothing."""
    have, text = docs.columns, fresh("text", docs.columns)
    for blocks, index in _indexes(benchmark, item_col, item_text):
        rows = docs.withColumn(text, F.col(text_col).cast("string"))

        def run(batches, ix=index):
            hasher = WordHasher()
            for b in slabs(batches, text, _SLAB):
                held = {t for t, _ in search(ix, hasher(b.column(text).to_pylist()), least)}
                stay = [t for t in range(b.num_rows) if t not in held]
                yield b.select(have).take(pa.array(stay, pa.int64()))

        docs = map_texts(rows if text != text_col else docs, run, docs.schema)
        if blocks > 1:
            docs = stored(docs, "without-leaks")
    return docs
