"""Near-duplicate embeddings by spherical-cap filters from product codes.

A code turns a vector by a fixed random rotation, cuts it into two halves and
has `DIRECTIONS` fixed random directions for each; every pair of directions is
one filter, DIRECTIONS^2 of them, and its value is the sum of the two inner
products. A vector is in all filters whose value reaches the cap, which is set
so that a random unit vector of its dimension is in `LIST` filters of a code in
the mean: it is decoded to that list half by half, without forming the other
filters. `CODES`
independent codes are used, as the lists of one code vary in length. Measured on
random pairs of 64 dimensions, 0.993 share a filter at a cosine of exactly 0.95
(the worst case), 0.997 at 0.97 and all at 0.99; 0.98 in 24 dimensions and 0.997
in 256 at 0.95. In few dimensions so many directions would make caps smaller
than the angle looked for, so a code has fewer there, and 0.998 share a filter.
Random vectors of 64 dimensions share a filter with probability 4e-4, of 12 with
6e-3, of 4 with 0.3, where filters are large and go by pairs of blocks.

Vectors meet where they share a filter and are compared in double precision.
Identical vectors are one class from the start. A filter that one class is
in alone is dropped before vectors move. A filter of more than `bucket_rows`
classes is cut into blocks, every pair of blocks a task of its own, so no task
holds more than two blocks. A pair is counted by the first filter that both are
in, so link counts are sums of what the tasks count, and no table of pairs is
made; for the components each task adds a spanning forest of its links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickguard.llm.common import ragged, stored
from clickguard.llm.components import connected_components, roots

SEED = 4
CODES, DIRECTIONS, LIST = 8, 1024, 4.5
_PROBES, _TOP = 256, 64
BUCKET_ROWS = 2000
#: Runs of up to so many rows are compared by vectors over the whole chunk.
SHORT_RUN = 8
CHUNK_ROWS = 50_000
_COLUMNS = 4096


def directions(dim: int) -> int:
    """How many directions each half of a code has."""
    return DIRECTIONS if dim >= 18 else 1 << max(dim, 2) // 2 + 1


def codes(dim: int):
    """Per code the directions of both halves, rotation included, as arrays
    [directions, dim] scaled so that a value is a standard normal number."""
    r = np.random.RandomState((SEED, dim))
    even = dim + dim % 2
    half = even // 2
    for _ in range(CODES):
        turn = np.linalg.qr(r.standard_normal((even, even)))[0]
        both = []
        for k in (0, 1):
            g = r.standard_normal((directions(dim), half))
            g *= np.sqrt(half) / np.linalg.norm(g, axis=1, keepdims=True)
            both.append((g @ turn[:, k * half:(k + 1) * half].T)[:, :dim])
        yield both


def cap(dim: int, code) -> float:
    """The value that `LIST` filters of a code reach in the mean of fixed
    random unit vectors; the largest sums are among those of the largest
    products of either half."""
    x = np.random.RandomState((SEED, dim, 1)).standard_normal((_PROBES, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    top = min(_TOP, len(code[0]))
    left, right = (np.partition(x @ d.T, -top, axis=1)[:, -top:] for d in code)
    sums = (left[:, :, None] + right[:, None]).ravel()
    n = int(LIST * _PROBES)
    return float(np.partition(sums, -n)[-n])


class Decoder:
    """Filter lists of vectors, for any dimensions."""

    def __init__(self):
        self.codes: dict[int, list] = {}
        self.caps: dict[int, float] = {}

    def __call__(self, unit: np.ndarray):
        """(row, filter) of all filters that the unit vectors are in."""
        dim = unit.shape[1]
        if dim not in self.codes:
            self.codes[dim] = list(codes(dim))
            self.caps[dim] = cap(dim, self.codes[dim][0])
        least = self.caps[dim]
        rows, found = [], []
        for c, (a, b) in enumerate(self.codes[dim]):
            left, right = unit @ a.T, unit @ b.T
            order = np.argsort(-right, axis=1)
            right = -np.take_along_axis(right, order, axis=1)  # ascending
            row, first = np.nonzero(left >= least + right[:, :1])
            need = left[row, first] - least  # right <= need
            n = np.array([np.searchsorted(right[i], x, "right") for i, x in zip(row, need)], np.int64)
            r = np.repeat(row, n)
            second = order[r, ragged(np.zeros(len(n), np.int64), n)]
            rows.append(r)
            found.append((np.repeat(first, n) + c * DIRECTIONS) * DIRECTIONS + second)
        return np.concatenate(rows), np.concatenate(found)


def unit_vectors(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither over- nor underflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _valid(column: str) -> F.Column:
    ok = F.forall(column, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(ok & F.exists(column, lambda v: v != 0), F.lit(False))


def _filters(classes: DataFrame) -> DataFrame:
    """Adds x (components as float64 bytes) and list (filter numbers, sorted)."""

    def run(batches):
        decode = Decoder()
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                vec = part.column("v")
                size = vec.value_lengths().to_numpy(zero_copy_only=False)
                flat = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                begin = np.cumsum(size) - size
                raw, lists = [None] * len(size), [None] * len(size)
                for dim in np.unique(size):
                    mine = np.flatnonzero(size == dim)
                    x = flat[begin[mine][:, None] + np.arange(dim)]
                    row, f = decode(unit_vectors(x))
                    order = np.lexsort((f, row))
                    cut = np.searchsorted(row[order], np.arange(len(mine) + 1))
                    for k, i in enumerate(mine):
                        raw[i] = x[k].tobytes()
                        # filters of another dimension are other filters
                        lists[i] = (int(dim) << 32) + f[order[cut[k]:cut[k + 1]]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("c"), part.column("w"), pa.array(raw, pa.binary()),
                     pa.array(lists, pa.list_(pa.int64()))], ["c", "w", "x", "list"])

    return classes.select("c", "w", "v").mapInArrow(run, "c long, w long, x binary, list array<long>")


class _Linker:
    """Links in buckets; rows come sorted by bucket (f, lo, hi)."""

    def __init__(self, least: float):
        self.least = least

    def __call__(self, batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            if held.num_rows >= CHUNK_ROWS:
                key = self.keys(held)
                n = int(np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])[-1])
                yield from self.chunk(held.slice(0, n))
                held = held.slice(n)
        if held is not None:
            yield from self.chunk(held)

    @staticmethod
    def keys(t):
        return np.stack([t.column(c).to_numpy() for c in ("f", "lo", "hi")], axis=1)

    def chunk(self, t):
        if t.num_rows < 2:
            return
        key = self.keys(t)
        c, w, block = (t.column(k).to_numpy() for k in ("c", "w", "block"))
        raw = t.column("x").to_pylist()
        lists = t.column("list").to_pylist()
        self.counts, self.edges = [], []
        cut = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1), True])
        size = np.diff(cut)
        few = np.flatnonzero(np.repeat((size > 1) & (size <= SHORT_RUN), size))
        for dim in np.unique([len(raw[i]) for i in few]):  # a bucket has one dimension
            at = np.array([i for i in few if len(raw[i]) == dim])
            x = unit_vectors(np.frombuffer(b"".join(raw[i] for i in at)).reshape(len(at), -1))
            for o in range(1, SHORT_RUN):
                if len(at) <= o:
                    break
                i = np.flatnonzero((key[at[:-o]] == key[at[o:]]).all(axis=1))
                if not len(i):
                    break
                # the halves of a bucket of two blocks meet each other only
                i = i[(key[at[i], 1] == key[at[i], 2]) | (block[at[i]] != block[at[i + o]])]
                i = i[np.einsum("ij,ij->i", x[i], x[i + o]) >= self.least]
                for a, b in zip(at[i], at[i + o]):
                    self.edges.append(np.array([[c[a]], [c[b]]]))
                    if min(set(lists[a]) & set(lists[b])) == key[a, 0]:
                        self.counts.append(np.array([[c[a], c[b]], [w[b], w[a]]]))
        for k in np.flatnonzero(size > SHORT_RUN):
            s = slice(cut[k], cut[k + 1])
            self.bucket(key[cut[k]], c[s], w[s], block[s], raw[s], lists[s])
        yield from (self.rows(kind, np.concatenate(found, axis=1))
                    for kind, found in ((0, self.counts), (1, self.edges)) if found)

    def bucket(self, key, c, w, block, raw, lists):
        f, lo, hi = key
        x = unit_vectors(np.frombuffer(b"".join(raw)).reshape(len(raw), -1))
        a = np.flatnonzero(block == lo)
        b = np.flatnonzero(block == hi) if hi != lo else a
        near = x[a] @ x[b].T >= self.least
        if hi == lo:
            np.fill_diagonal(near, False)
        if not near.any():
            return
        i, j = np.nonzero(near)
        node = np.arange(len(c))
        root = roots(a[i], b[j], len(c))
        out = root != node
        self.edges.append(np.stack([c[out], c[root[out]]]))
        # pairs that share a smaller filter are counted there
        row = np.repeat(node, [len(x) for x in lists])
        flat = np.concatenate([np.asarray(x, np.int64) for x in lists])
        row, flat = row[flat < f], flat[flat < f]
        known, at = np.unique(flat, return_inverse=True)
        for first in range(0, len(known), _COLUMNS):
            mine = (at >= first) & (at < first + _COLUMNS)
            m = np.zeros((len(c), min(_COLUMNS, len(known) - first)), np.float32)
            m[row[mine], at[mine] - first] = 1
            near &= m[a] @ m[b].T == 0
        self.counts.append(np.stack([c[a], near @ w[b]]))
        if hi != lo:
            self.counts.append(np.stack([c[b], near.T @ w[a]]))

    @staticmethod
    def rows(kind, ab):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(ab.shape[1], kind, np.int8)), pa.array(ab[0].astype(np.int64)),
             pa.array(ab[1].astype(np.int64))], ["kind", "a", "b"])


def _links(vectors: DataFrame, least: float, bucket_rows: int) -> DataFrame:
    """Of classes (c, w, x, list): rows (0, class, linked vectors) to sum up and
    (1, class, class) that connect what links connect."""
    alone = vectors.select("c", F.explode("list").alias("f"))
    met = alone.groupBy("f").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / bucket_rows).cast("int")
    hits = (alone.join(met, "f")
            .withColumn("block", F.pmod(F.xxhash64("c"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .select("f", "c", "block", F.least("block", "other").alias("lo"),
                    F.greatest("block", "other").alias("hi")))
    return (hits.join(vectors, "c").repartition("f", "lo", "hi")
            .sortWithinPartitions("f", "lo", "hi", "c")
            .select("f", "lo", "hi", "block", "c", "w", "x", "list")
            .mapInArrow(_Linker(least), "kind byte, a long, b long"))


def embedding_duplicates(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                         least: float = 0.95, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(`id_col`, n_links, component_id, kept) per row of `rows`.

    Vectors link at a cosine of `least` or more in double precision. n_links
    counts the other rows linked directly, copies included; component_id is the
    smallest id reachable, itself included; kept: the id is the component's.
    Null and zero vectors, those with null or non-finite components, and vectors
    of different lengths link with nothing. A null id names no component that
    has another id, and is kept only where it has none. Repeated rows stay and
    link with each other; an empty table gives an empty one; other columns
    are not read.
    """
    number = T.DoubleType() if "double" in rows.schema[vec_col].dataType.simpleString() else T.FloatType()
    kind = T.ArrayType(number)
    plain = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(kind).alias("v"))
    good = plain.where(_valid("v"))
    classes = stored(good.groupBy("v").agg(F.min("id").alias("low"), F.count("*").alias("w"))
                     .withColumn("c", F.monotonically_increasing_id()), "embedding-classes")
    vectors = stored(_filters(classes), "embedding-filters")
    found = stored(_links(vectors, least, bucket_rows), "embedding-links")
    linked = found.where("kind = 0").groupBy(F.col("a").alias("c")).agg(F.sum("b").alias("n"))
    nodes = connected_components(found.where("kind = 1")).withColumnRenamed("node", "c")
    named = (classes.join(nodes, "c", "left")
             .select("c", "low", "w", "v", F.coalesce("component", "c").alias("component")))
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    per_class = (named.join(lowest, "component").join(linked, "c", "left")
                 .select("v", "component_id", (F.col("w") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")))
    ok = good.join(per_class, "v").select("id", "n_links", "component_id")
    rest = plain.where(~_valid("v")).select("id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("id").alias("component_id"))
    return (ok.unionByName(rest)
            .select(F.col("id").alias(id_col), "n_links", "component_id",
                    F.col("id").eqNullSafe(F.col("component_id")).alias("kept")))
