"""Periodic runs of a text's words by longest common extensions on suffix trees.

A run is a stretch of words with smallest period q, at least `min_exponent`
periods and `min_length` words long, that cannot be extended. Its Lyndon root is
the longest Lyndon word from some position on, under one order of the words or
the reversed one, so the candidates of position i are (i, next smaller suffix)
and (i, next greater suffix): two periods per word, whatever the text. Each is
extended to the right by the longest common extension of its two suffixes in
Ukkonen's tree of the document, to the left by the one in the tree of the
reversed document. The extension is the depth of the lowest common ancestor of
two leaves: a range minimum over the depths that an Euler tour passes between
leaves, answered from a sparse table in constant time, for all candidates at
once. The tour visits children in the order of their words, so it also gives the
order of suffixes that the Lyndon roots need.

Every word of a run occurs in it at least `min_exponent` times. Words that occur
less often in their stretch belong to no run and part the document; this is
repeated for the stretches left, and the trees are built over what remains, the
parted stretches kept apart by words of their own. Prose leaves nothing; a
document that repeats itself is built whole. The result is the same either way.

Map only, no shuffle: a task holds a slab of texts and the trees of one document
(about 500 bytes for each of its remaining words).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickguard.llm.common import fresh, map_texts, slabs

#: Rounds of parting; more would drop words sooner, not change results.
ROUNDS = 12


def suffix_tree(s: list[int], symbols: int):
    """Ukkonen's tree of `s`, numbers below `symbols` whose last occurs nowhere
    else: (child, depth, suffix). child[node * symbols + symbol] is a node whose
    path from the root is s[suffix : suffix + depth]; the root is 0."""
    n = len(s)
    depth, suffix, link = [0], [0], [0]
    child: dict[int, int] = {}
    get = child.get
    node = todo = 0  # the suffixes of the last `todo` symbols are yet to come
    for i, c in enumerate(s):
        todo += 1
        inner = 0
        while todo:
            d = depth[node]
            if todo - 1 == d:
                key = node * symbols + c
                if key in child:
                    if inner:
                        link[inner] = node
                    break
                top = node
            else:
                edge = node * symbols + s[i - todo + 1 + d]
                below = get(edge)
                if depth[below] < todo:
                    node = below
                    continue
                onward = s[suffix[below] + todo - 1]
                if onward == c:
                    break
                top = len(depth)
                depth.append(todo - 1)
                suffix.append(i - todo + 1)
                link.append(0)
                child[edge] = top
                child[top * symbols + onward] = below
                key = top * symbols + c
            child[key] = len(depth)
            depth.append(n - i + todo - 1)
            suffix.append(i - todo + 1)
            link.append(0)
            if inner:
                link[inner] = top
            inner = top if top != node else 0
            todo -= 1
            node = link[node]
    return child, depth, suffix


class Extensions:
    """Longest common extensions of suffixes of `s`, by its suffix tree."""

    def __init__(self, s: list[int], symbols: int):
        child, depth, suffix = suffix_tree(s, symbols)
        n, nodes = len(s), len(depth)
        key = np.fromiter(child.keys(), np.int64, len(child))
        kid = np.fromiter(child.values(), np.int64, len(child))
        del child
        order = np.argsort(key)[::-1]
        kid, parent = kid[order], key[order] // symbols
        at = np.searchsorted(-parent, -np.arange(nodes), "left")
        stop = np.searchsorted(-parent, -np.arange(nodes), "right")
        # the tour comes from a child that is not its parent's first by way of the parent
        turn = np.full(nodes, -1)
        last = np.r_[parent[1:] != parent[:-1], True]
        turn[kid[~last]] = np.asarray(depth)[parent[~last]]
        leaf, low = self._tour(kid.tolist(), at.tolist(), stop.tolist(), turn.tolist())
        self.rank = np.empty(n, np.int64)
        self.rank[np.asarray(suffix)[leaf]] = np.arange(n)
        self.table = [np.asarray(low, np.int32)]
        while 2 << len(self.table) - 1 <= n:
            t, w = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(t[:-w], t[w:]))

    @staticmethod
    def _tour(kid, at, stop, turn):
        """The leaves by an Euler tour, with the least depth passed since the last."""
        leaf, low, lowest, stack = [], [], 0, [0]
        while stack:
            v = stack.pop()
            if turn[v] >= 0:
                lowest = turn[v]
            if at[v] == stop[v]:
                leaf.append(v)
                low.append(lowest)
            else:
                stack += kid[at[v]:stop[v]]
        return leaf, low

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For i != j, how many symbols s[i:] and s[j:] begin with alike."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp(b - a)[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            m = level == k
            t = self.table[k]
            out[m] = np.minimum(t[a[m]], t[b[m] - (1 << int(k))])
        return out


def _next_lower(rank: list[int]):
    """Pairs (i, j): j is the first position after i whose rank is less."""
    left, right, stack = [], [], []
    for j, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            left.append(stack.pop())
            right.append(j)
        stack.append(j)
    return left, right


def string_runs(s: list[int], symbols: int, min_exponent: int, min_length: int):
    """(start, length, period) arrays of the runs of `s` by start, then period;
    its last symbol occurs nowhere else."""
    n = len(s) - 1
    ahead = Extensions(s, symbols)
    pairs = [_next_lower(r) for r in (ahead.rank.tolist(), (-ahead.rank).tolist())]
    i, j = (np.array(x + y, np.int64) for x, y in zip(*pairs))
    right = j + ahead(i, j)
    back = Extensions(s[n - 1::-1] + s[n:] if n else s, symbols)
    left = i - back(n - i, n - j)
    size, period = right - left, j - i
    ok = size >= np.maximum(min_length, min_exponent * period)
    found = np.unique(np.stack([left[ok], period[ok], size[ok]], axis=1), axis=0)
    return found[:, 0], found[:, 2], found[:, 1]


def part(word: np.ndarray, doc: np.ndarray, min_exponent: int, min_length: int):
    """Of words (numbers that documents do not share) with their documents, the
    positions that may be in a run and their stretches."""
    at, piece = np.arange(len(word)), doc
    for left in range(ROUNDS, -1, -1):
        if left < ROUNDS:
            piece = np.cumsum(np.r_[True, (np.diff(at) > 1) | (np.diff(piece) != 0)])[:len(at)] - 1
        if not len(at):
            break
        long = np.bincount(piece)[piece] >= min_length
        at, piece = at[long], piece[long]
        if not left or not len(at):
            break
        # the first time documents are the stretches, which share no words
        of = word[at] if left == ROUNDS else np.unique(
            piece * (int(word.max()) + 1) + word[at], return_inverse=True)[1]
        often = np.bincount(of)[of] >= min_exponent
        if left < ROUNDS and often.all():
            break
        at, piece = at[often], piece[often]
    return at, piece


def document_runs(word: np.ndarray, piece: np.ndarray, at: np.ndarray, min_exponent: int, min_length: int):
    """Runs of a document from the words at positions `at` in their stretches."""
    first = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
    known, small = np.unique(word, return_inverse=True)
    n, k = len(word), len(first)
    place = np.arange(n) + np.cumsum(np.r_[False, piece[1:] != piece[:-1]])
    s = np.empty(n + k, np.int64)
    s[place] = small
    gap = np.ones(n + k, bool)
    gap[place] = False
    s[gap] = len(known) + np.arange(k)  # a stretch ends with a word of its own
    start, length, period = string_runs(s.tolist(), len(known) + k, min_exponent, min_length)
    origin = np.zeros(n + k, np.int64)
    origin[place] = at
    return origin[start], length, period


def _collapsed(words: list[bytes], start, length, period) -> bytes:
    drop = np.zeros(len(words) + 1, np.int64)
    np.add.at(drop, start + period, 1)
    np.add.at(drop, start + length, -1)
    keep = np.cumsum(drop)[:-1] == 0
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_exponent: int = 4, min_length: int = 6) -> DataFrame:
    """(`id_col`, n_words, runs, collapsed) per row of `docs`.

    runs: array of (start, length, period), counted in words from 0, by start,
    then period: all maximal stretches with smallest period q that are at least
    `min_length` words and `min_exponent` (2 or more) periods long. Words are
    runs of bytes other than space and \\t..\\r and are compared byte by byte.
    collapsed: the words joined by one space, without those that any run
    contains after its first q. Null and empty texts have no words, no runs and
    an empty collapsed text. Rows with null or repeated ids are rows as any
    other; an empty table gives an empty one; other columns are not read, and
    output names that `id_col` has taken get an underscore in front.
    """
    if min_exponent < 2:
        raise ValueError("min_exponent must be 2 or more")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    run_type = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def run(batches):
        for b in slabs(batches, "text"):
            words = [t.split() if t else [] for t in b.column("text").cast(pa.binary()).to_pylist()]
            number, size, base = [], np.array([len(w) for w in words]), 0
            for mine in words:
                ids: dict[bytes, int] = {}
                number.append(np.array([ids.setdefault(w, len(ids)) for w in mine], np.int64) + base)
                base += len(ids)
            word = np.concatenate(number)
            begin = np.cumsum(size) - size
            at, piece = part(word, np.repeat(np.arange(len(words)), size), min_exponent, min_length)
            cut = np.searchsorted(at, np.r_[begin, len(word)])
            counts, flat, texts = [], [], []
            for d, mine in enumerate(words):
                lo, hi = cut[d], cut[d + 1]
                found = [np.zeros(0, np.int64)] * 3
                if hi > lo:
                    found = document_runs(word[at[lo:hi]], piece[lo:hi], at[lo:hi] - begin[d],
                                          min_exponent, min_length)
                counts.append(len(found[0]))
                flat.append(found)
                texts.append(_collapsed(mine, *found) if len(found[0]) else b" ".join(mine))
            runs = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(counts)], pa.int32()),
                pa.StructArray.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*flat)],
                                           fields=list(run_type)))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(size, pa.int64()), runs,
                 pa.array(texts, pa.binary()).cast(pa.string())], ["id", "n_words", "runs", "collapsed"])

    found = map_texts(rows, run, f"id {kind}, n_words long, "
                                 "runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return found.select(F.col("id").alias(id_col),
                        *[F.col(c).alias(fresh(c, [id_col])) for c in ("n_words", "runs", "collapsed")])


def looped(text: Column, h: Column) -> Column:
    """The words of `text`, from number g % n on the first 1 + (n - g % n) div
    (3 + g % 8) of them over and over, where g = h div 10 and h % 10 = 0; other
    texts as they are."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, g = F.size(words), F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    copies = F.ceil((n - a) / p).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), copies)), F.lit(1), n - a)
    return F.when((h % 10 == 0) & (n > 0),
                  F.array_join(F.concat(F.slice(words, F.lit(1), a), again), " ")).otherwise(text)


def run_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Of `periodic_runs`: the number of runs, the longest (ties: smallest
    start, then period) and SHA-256 digests of all runs and the collapsed text."""
    runs = F.col("runs")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size(runs) > 0, "\n").otherwise(""))
    return (found.withColumn("longest", longest)
            .select(id_col, F.size(runs).cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"),
                    F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
                    F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
                    F.sha2(text, 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))
