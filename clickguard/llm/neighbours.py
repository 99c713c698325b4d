"""Approximate nearest neighbours by learned partitions.

The index is fitted on a bounded sample: the exact neighbour graph of the sample
is cut into parts of equal size by recursive bisection (halves along the smoothest
function on the graph, then swaps that cut fewer edges), and a small network with
one hidden layer learns to tell, from a vector alone, the parts that it and its
neighbours are in. Every row belongs to its most probable part. A query goes to
its `probes` most probable parts and is compared there with every row, in double
precision. `probes` is the least number that finds `TARGET` of the neighbours of
held-out sample rows, which the network has not seen; neighbours in the whole
table are closer than those in the sample, and closer ones share parts more often.

Equal vectors are one class that keeps its `k + 1` smallest ids, which are all
that can be among anyone's k nearest: a vector that a third of the rows hold is
compared once. Classes and queries that share a part meet in blocks of up to
`BLOCK_ROWS` classes, so a part that grows is more tasks, not a larger one.

Scale: one shuffle of the vectors to make classes (cut to k + 1 rows a vector and
map task before it), one of classes and routed queries by (part, block). What the
driver holds is the sample (`SAMPLE` rows, `SAMPLE_NUMBERS` components at most),
its graph and the network.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickguard.llm.common import fresh, stored

SEED = 11
#: Rows, and components, of the sample that the index is fitted on.
SAMPLE, SAMPLE_NUMBERS = 16_384, 1 << 22
#: Share of the sample held out to choose the probes, and the recall aimed at.
HELD_OUT, TARGET = 1 / 8, 0.97
#: Parts of a table of up to LEAST_PARTS * BLOCK_ROWS classes; a larger one has
#: parts of about BLOCK_ROWS, and none has parts of fewer than SAMPLE_PART sample rows.
LEAST_PARTS, SAMPLE_PART = 64, 20
GRAPH, HIDDEN, EPOCHS, BATCH, RATE = 10, 128, 20, 256, 2e-3
BLOCK_ROWS = 8192
#: Parts of vectors of different lengths are different parts.
_DIM = 1 << 20


def _valid(column: str) -> F.Column:
    ok = F.forall(column, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(ok & F.exists(column, lambda v: v != 0), F.lit(False))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all of b, up to rounding."""
    return (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)


def _graph(spark, x: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """Per query the k nearest rows of x, found in Spark tasks."""

    def run(batches):
        for b in batches:
            i = b.column("id").to_numpy()
            for lo in range(0, len(i), 256):
                mine = i[lo:lo + 256]
                near = squared(queries[mine], x)
                near[near <= 1e-12 * (x * x).sum(1).max()] = np.inf  # a row is not its own neighbour
                at = np.argpartition(near, k - 1, axis=1)[:, :k]
                yield pa.RecordBatch.from_arrays([pa.array(mine), pa.array(list(at), pa.list_(pa.int64()))],
                                                 ["id", "near"])

    out = np.zeros((len(queries), k), np.int64)
    for i, near in spark.range(0, len(queries), 1, 16).mapInArrow(run, "id long, near array<long>").collect():
        out[i] = near
    return out


def _halves(x: np.ndarray, a: np.ndarray, b: np.ndarray, first: int) -> np.ndarray:
    """Which `first` nodes of a graph (edges a-b both ways) are the first part."""
    n = len(x)
    degree = np.maximum(np.bincount(a, minlength=n), 1)
    y = x - x.mean(0)
    f = y @ np.linalg.eigh(y.T @ y)[1][:, -1]
    for _ in range(40):  # smooth along the edges, constant part out
        f = (f + np.bincount(a, f[b], n) / degree) / 2
        f -= (f * degree).sum() / degree.sum()
        f /= np.abs(f).max() or 1
    side = np.ones(n, bool)
    side[np.argsort(f, kind="stable")[:first]] = False
    cut = (side[a] != side[b]).sum()
    for _ in range(20):  # swap the nodes that have most neighbours on the other side
        other = np.bincount(a, side[a] != side[b], n)
        gain = 2 * other - np.bincount(a, minlength=n)
        left, right = (m[np.argsort(-gain[m], kind="stable")] for m in (np.flatnonzero(~side), np.flatnonzero(side)))
        most = min(len(left), len(right), max(1, n // 20))
        swap = int((gain[left[:most]] + gain[right[:most]] > 0).sum())
        new = side.copy()
        new[left[:swap]], new[right[:swap]] = True, False
        less = (new[a] != new[b]).sum()
        if not swap or less >= cut:
            break
        side, cut = new, less
    return ~side


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int) -> np.ndarray:
    """Part of every row: `parts` parts of equal size (up to one row) that cut
    few edges of the neighbour graph."""
    a = np.repeat(np.arange(len(x)), near.shape[1])
    a, b = np.r_[a, near.ravel()], np.r_[near.ravel(), a]
    label = np.zeros(len(x), np.int64)
    todo = [(np.arange(len(x)), a, b, 0, parts)]
    while todo:
        rows, a, b, low, n = todo.pop()
        if n == 1 or len(rows) < 2:
            label[rows] = low
            continue
        half = n // 2
        first = _halves(x[rows], a, b, len(rows) * half // n)
        for mine, start, count in ((first, low, half), (~first, low + half, n - half)):
            number = np.cumsum(mine) - 1
            both = mine[a] & mine[b]
            todo.append((rows[mine], number[a[both]], number[b[both]], start, count))
    return label


class Router:
    """A network that gives the probable parts of vectors of one length."""

    def __init__(self, x: np.ndarray, share: np.ndarray):
        """`share`: per row the share of its neighbours that each part holds."""
        r = np.random.RandomState(SEED)
        dim, parts = x.shape[1], share.shape[1]
        self.shift, self.scale = x.mean(0), x.std() or 1.0
        z = self._scaled(x)
        net = [r.standard_normal((dim, HIDDEN)) * np.sqrt(2 / dim), np.zeros(HIDDEN),
               r.standard_normal((HIDDEN, parts)) * np.sqrt(1 / HIDDEN), np.zeros(parts)]
        self.net = [w.astype(np.float32) for w in net]
        mean, var = ([np.zeros_like(w) for w in self.net] for _ in (0, 1))
        step, share = 0, share.astype(np.float32)
        for epoch in range(EPOCHS if parts > 1 else 0):
            order = r.permutation(len(z))
            for lo in range(0, len(z), BATCH):
                mine = order[lo:lo + BATCH]
                hidden, p = self._forward(z[mine])
                d = (p - share[mine]) / len(mine)
                back = (d @ self.net[2].T) * (hidden > 0)
                step += 1
                rate = RATE * (1 - epoch / EPOCHS) * np.sqrt(1 - .999 ** step) / (1 - .9 ** step)
                for w, m, v, g in zip(self.net, mean, var, (z[mine].T @ back, back.sum(0), hidden.T @ d, d.sum(0))):
                    m += .1 * (g - m)
                    v += .001 * (g * g - v)
                    w -= rate * m / (np.sqrt(v) + 1e-8)

    def _scaled(self, x):
        return np.nan_to_num((x - self.shift) / self.scale, posinf=1e6, neginf=-1e6).clip(-1e6, 1e6).astype(np.float32)

    def _forward(self, z):
        hidden = np.maximum(z @ self.net[0] + self.net[1], 0)
        e = hidden @ self.net[2] + self.net[3]
        e = np.exp(e - e.max(1, keepdims=True))
        return hidden, e / e.sum(1, keepdims=True)

    def __call__(self, x: np.ndarray, n: int = 1) -> np.ndarray:
        """The n most probable parts of every row, best first."""
        p = self._forward(self._scaled(x))[1]
        return np.argsort(-p, axis=1, kind="stable")[:, :n]


def fit(spark, x: np.ndarray, rows: int, k: int):
    """(router, probes, held-out recall) for a table of `rows` classes from
    sample vectors, in an order that has nothing to do with them."""
    held = int(len(x) * HELD_OUT)
    test, x = x[:held], x[held:]
    parts = min(max(LEAST_PARTS, rows // BLOCK_ROWS), len(x) // SAMPLE_PART)
    if parts < 2 or not held:
        return Router(x, np.ones((len(x), 1))), 1, 1.0
    near = _graph(spark, x, x, GRAPH)
    label = balanced_parts(x, near, parts)
    share = np.zeros((len(x), parts))
    for column in (np.arange(len(x)), *near.T):
        share[np.arange(len(x)), label[column]] += 1 / (1 + GRAPH)
    router = Router(x, share)
    place = router(x)[:, 0]
    k = min(k, len(x))
    wanted = place[_graph(spark, x, test, k)]
    rank = np.argsort(router(test, parts), axis=1, kind="stable")  # of each part for each row
    found = np.cumsum(np.bincount(np.take_along_axis(rank, wanted, axis=1).ravel(), minlength=parts)) / wanted.size
    probes = int(np.searchsorted(found, TARGET)) + 1
    return router, min(probes, parts), float(found[min(probes, parts) - 1])


def _matrix(column: pa.Array, rows: np.ndarray) -> np.ndarray:
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    begin = np.cumsum(size) - size
    return flat[begin[rows][:, None] + np.arange(size[rows[0]])]


def _routed(rows: DataFrame, models: dict, probe: bool) -> DataFrame:
    """`rows` (v and others) with `part`, once for each part to search with
    `probe`, else once."""

    def run(batches):
        for b in batches:
            size = b.column("v").value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(size):
                router, probes, _ = models[int(dim)]
                mine = np.flatnonzero(size == dim)
                part = router(_matrix(b.column("v"), mine), probes if probe else 1)
                for column in part.T:
                    yield pa.RecordBatch.from_arrays(
                        [*b.take(pa.array(mine)).columns, pa.array(column + int(dim) * _DIM)],
                        [*b.schema.names, "part"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{fields}, part long")


class _Searcher:
    """Compares queries with the classes of their block; rows come sorted by
    (part, block, query), a block's classes before its queries."""

    def __init__(self, k: int):
        self.k = k

    def __call__(self, batches):
        block, pieces, held = None, [], None
        for b in batches:
            key = np.stack([b.column("part").to_numpy(), b.column("block").to_numpy(),
                            b.column("query").to_numpy(zero_copy_only=False)], axis=1)
            cut = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1), True])
            for lo, hi in zip(cut, cut[1:]):
                some = b.slice(lo, hi - lo)
                if tuple(key[lo, :2]) != block:
                    block, pieces, held = tuple(key[lo, :2]), [], None
                if not key[lo, 2]:
                    pieces.append((_matrix(some.column("v"), np.arange(hi - lo)), some.column("ids").to_pylist()))
                    continue
                if pieces:
                    held = np.concatenate([x for x, _ in pieces]), [i for _, ids in pieces for i in ids]
                    pieces = []
                if held:
                    yield from self.near(some, *held)

    def near(self, queries, x, ids):
        most = (x * x).sum(1).max()
        for lo in range(0, queries.num_rows, 256):
            part = queries.slice(lo, 256)
            q = _matrix(part.column("v"), np.arange(part.num_rows))
            with np.errstate(all="ignore"):
                d = squared(q, x)
                k = min(self.k, len(x))
                slack = 1e-12 * ((q * q).sum(1) + most)[:, None]
                kth = np.partition(np.where(np.isnan(d), -np.inf, d), k - 1, axis=1)[:, k - 1:k]
                row, at = np.nonzero(~(d > kth + 2 * slack))
                score = np.sqrt(((q[row] - x[at]) ** 2).sum(1))
            c, of, key, near = part.column("c").to_numpy(), [], [], []
            cut = np.searchsorted(row, np.arange(len(q) + 1))
            for i in range(len(q)):
                s = slice(cut[i], cut[i + 1])
                hits = sorted((v, key) for v, a in zip(score[s].tolist(), at[s].tolist()) for key in ids[a])[:self.k]
                of += [c[i]] * len(hits)
                near += [v for v, _ in hits]
                key += [h for _, h in hits]
            yield pa.RecordBatch.from_arrays([pa.array(of, pa.int64()), pa.array(key, pa.int64()),
                                              pa.array(near, pa.float64())], ["c", "id", "score"])


def _first(rows: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of each group, with their `place`."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def _classes(rows: DataFrame, name: str) -> DataFrame:
    return stored(rows.withColumn("c", F.monotonically_increasing_id()), name)


def fit_index(classes: DataFrame, k: int) -> dict:
    """{length: (router, probes, held-out recall)} from samples of the classes."""
    models = {}
    sizes = classes.groupBy(F.size("v").alias("dim")).count().collect()  # one row per length
    for dim, rows in sorted(sizes):
        want = max(1, min(SAMPLE, SAMPLE_NUMBERS // dim, rows))
        # a little more than wanted by hash, cut to size here
        bar = min(1.0, 1.1 * want / rows + 1e-3) * (1 << 32)
        h = F.xxhash64("v", F.lit(SEED))
        drawn = (classes.where((F.size("v") == dim) & (F.pmod(h, F.lit(1 << 32)) < bar))
                 .select(h.alias("h"), "v").collect())
        drawn = sorted(drawn, key=lambda r: (r[0], r[1]))[:want]
        x = np.array([r[1] for r in drawn], np.float64).reshape(len(drawn), dim)
        models[dim] = fit(classes.sparkSession, x, rows, k)
    return models


def nearest_neighbours(rows: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
                       vec_col: str = "embedding", query_col: str = "query_id",
                       block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(`query_col`, rank, `id_col`, score) of the `k` nearest rows found for
    each row of `queries`, which has the columns of `rows`: smallest Euclidean
    distance in double precision (score), ties to the smaller id.

    A query's own row, of the same id and vector, is no candidate; rows that
    repeat id and vector are one, those that share an id only are each their
    own. Null ids, null and zero vectors and those with null or non-finite
    components take no part; vectors of another length are no candidates. Ids
    are whole numbers. Fewer than k candidates in the probed parts give fewer
    rows; empty tables an empty result. Other columns are not read; output
    names that are taken get an underscore in front.
    """
    if k < 1:
        raise ValueError("k must be 1 or more")
    number = T.DoubleType() if "float" not in rows.schema[vec_col].dataType.simpleString() else T.FloatType()

    def plain(df):
        return (df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(T.ArrayType(number)).alias("v"))
                .where(F.col("id").isNotNull() & _valid("v")))

    few = _first(plain(rows).groupBy("v", "id").agg(F.lit(1)).select("v", "id"), ["v"], ["id"], k + 1)
    classes = _classes(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "neighbours-classes")
    asked = stored(plain(queries).distinct(), "neighbours-queries")
    kinds = _classes(asked.select("v").distinct(), "neighbours-kinds")
    models = fit_index(classes, k)
    if not models:
        models = {0: None}
    index = stored(_routed(classes, models, probe=False), "neighbours-index")
    blocks = F.broadcast(index.groupBy("part").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")))
    placed = (index.join(blocks, "part")
              .select("part", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int").alias("block"),
                      F.lit(False).alias("query"), "c", "v", "ids"))
    known = kinds.where(F.size("v").isin(list(models)))
    probing = (_routed(known, models, probe=True).join(blocks, "part")
               .select("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                       F.lit(True).alias("query"), "c", "v", F.lit(None).cast("array<long>").alias("ids")))
    met = (placed.unionByName(probing).repartition("part", "block")
           .sortWithinPartitions("part", "block", "query", "c"))
    found = met.mapInArrow(_Searcher(k + 1), "c long, id long, score double")
    best = stored(_first(found, ["c"], ["score", "id"], k + 1)
                  .groupBy("c").agg(F.sort_array(F.collect_list(F.struct("score", "id"))).alias("hits")),
                  "neighbours-found")
    # equal queries, however many, share one row of results
    hits = (asked.withColumnRenamed("id", "query").join(kinds, "v").join(best, "c")
            .select("query", "c", F.filter("hits", lambda h: ~((h["id"] == F.col("query")) & (h["score"] == 0)))
                    .alias("hits"))
            .select("query", F.posexplode(F.slice("hits", 1, k)).alias("at", "hit")))
    taken = [query_col]
    for c in ("rank", id_col, "score"):
        taken.append(fresh(c, taken))
    values = F.col("query"), F.col("at") + 1, F.col("hit.id"), F.col("hit.score")
    return hits.select(*[v.alias(c) for v, c in zip(values, taken)])
