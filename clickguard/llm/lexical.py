"""Ranked lexical search by NRA (no random access) over impact-sorted lists.

Terms are maximal runs of ASCII letters and digits and of any character beyond
ASCII; only A-Z are lower-cased. N counts the documents with a term, L all their
terms, n a document's terms, df the documents that hold a term, tf its occurrences
in one. A term weighs w = floor(1000 ln((2N + 2) / (2 df + 1))), a document's length
counts as m = 75 + 25 n N div L, and an occurrence's impact is
w (10^9 tf div (1000 tf + 12 m)), all in 64-bit integers but for the logarithm.
A query scores the sum of impacts over its terms, repeats included.

The documents are scattered over tasks, and a task takes them in slabs. Within a
slab each query term has a list of (document, impact) sorted by impact. A query's
lists are read from the top in steps that grow, all side by side. A document's
lower bound is the sum of its impacts read; its upper bound adds, for each list it
has not been met in, the impact that this list would yield next. The k-th best
lower bound so far (of the slab, or of the task's earlier slabs) is the bar: a
document whose upper bound is below it is dropped for good, and once the next
impacts of all lists add up to less, new documents are not taken up. Reading goes
on until every document left has equal bounds, so membership, ties and scores are
final. The best k of every task meet in a second step that merges them in groups
first. Scores never depend on slabs or tasks, so the result doesn't either.

Scale: texts are read once per block of queries and leave a table of (document,
n, its query terms with counts); df comes from it by a map-side combined count.
Nothing but k rows per query and task is shuffled after that. A block is bounded
by its number of terms, which is what is sent to the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickguard.llm.common import fresh, map_texts, ragged, slabs, stored

#: Query terms (repeats included) sent to tasks at a time; a single longer query
#: is a block of its own.
BLOCK_TERMS = 200_000
#: Documents of a slab of lists (fewer where a query has very many lists), its
#: documents times lists at most, and the first step of reading a list.
SLAB_DOCS, SLAB_CELLS, FIRST_READ = 4096, 1 << 25, 32
#: Groups in which the best of tasks are merged before those of groups.
MERGE_GROUPS = 64

#: byte -> byte: A-Z to a-z, all ASCII but letters and digits to a space
_TABLE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(_TABLE).split() if text else []


def _query_blocks(items: DataFrame, id_col: str, text_col: str, block_terms: int):
    """Lists of (id, terms), at most `block_terms` terms together."""
    block, size = [], 0
    rows = items.select(F.col(id_col).alias("id"),
                        F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "utf-8").alias("t"))
    for r in rows.toLocalIterator():
        mine = terms(bytes(r["t"]))
        if block and size + len(mine) > block_terms:
            yield block
            block, size = [], 0
        if mine:
            block.append((r["id"], mine))
            size += len(mine)
    if block:
        yield block


def _occurrences(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(id, n, term, tf) per document with a term; `term` and `tf` are arrays
    of those in the vocabulary."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        get, size = vocabulary.get, len(vocabulary)
        for b in slabs(batches, "text"):
            n, rows, found = [], [], []
            for i, t in enumerate(b.column("text").cast(pa.binary()).to_pylist()):
                mine = terms(t)
                if not mine:
                    continue
                known = np.fromiter(map(get, mine, repeat(-1)), np.int64, len(mine))
                found.append(known[known >= 0] + len(rows) * size)
                n.append(len(mine))
                rows.append(i)
            if not rows:
                continue
            key, tf = np.unique(np.concatenate(found), return_counts=True)
            cut = pa.array(np.searchsorted(key, np.arange(len(rows) + 1) * size), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(rows)), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(cut, pa.array(key % max(size, 1), pa.int32())),
                 pa.ListArray.from_arrays(cut, pa.array(tf, pa.int32()))], ["id", "n", "term", "tf"])

    return map_texts(docs, run, f"id {kind}, n long, term array<int>, tf array<int>")


class Lists:
    """The impact-sorted lists of a slab of documents."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, vocabulary: int, docs: int):
        order = np.lexsort((-impact, term))
        self.doc, self.impact, self.docs = doc[order], impact[order], docs
        self.start = np.searchsorted(term[order], np.arange(vocabulary + 1))

    def best(self, term: np.ndarray, times: np.ndarray, k: int, bar: int):
        """(documents, scores): a superset of the best `k` documents by score
        that score `bar` or more, all scores above 0 and final."""
        start, stop = self.start[term], self.start[term + 1]
        some = stop > start
        start, stop, times = start[some], stop[some], times[some]
        lists, size = np.arange(len(start)), stop - start
        lower = np.zeros(self.docs, np.int64)
        met = np.zeros((self.docs, len(start)), bool)
        left = np.arange(self.docs)  # documents that may be among the best
        done, step = np.zeros(len(start), np.int64), FIRST_READ
        ahead = self.impact[start] * times
        while True:
            if len(left) > k:
                bar = max(bar, int(np.partition(lower[left], -k)[-k]))
            unread = ahead.sum() - met[left] @ ahead
            upper = lower[left] + unread
            may = upper >= max(bar, 1)
            left = left[may]
            if not unread[may].any():
                return left, lower[left]
            take = np.minimum(size - done, step)
            row = np.repeat(lists, take)
            at = ragged(start + done, take)
            hit = self.doc[at]
            np.add.at(lower, hit, self.impact[at] * times[row])
            met[hit, row] = True
            done += take
            step *= 2
            on = done < size
            ahead = np.where(on, self.impact[np.where(on, start + done, start)] * times, 0)


def _regrouped(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of `rows`, the last one shorter."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        while sum(x.num_rows for x in held) >= rows:
            t = pa.Table.from_batches(held).combine_chunks()
            yield t.slice(0, rows).to_batches()[0]
            held = t.slice(rows).to_batches()
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _search(batches: Iterator[pa.RecordBatch], weight: np.ndarray, queries, k: int, total: int, words: int):
    """The best `k` documents of a task for every query, as (query, id, score)."""
    best: list[list] = [[] for _ in queries]  # sorted by rank
    kind = None

    def order(hit):
        score, key = hit
        return -score, key is None, key if key is not None else 0

    for part in _regrouped(batches, max(64, min(SLAB_DOCS, SLAB_CELLS // max(len(w) for w, _ in queries)))):
        ids = part.column("id")
        kind = ids.type
        m = 75 + 25 * part.column("n").to_numpy() * total // words
        term, tf = (part.column(c).flatten().to_numpy().astype(np.int64) for c in ("term", "tf"))
        doc = np.repeat(np.arange(part.num_rows), part.column("term").value_lengths().to_numpy())
        impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[doc]))
        lists = Lists(doc, term, impact, len(weight), part.num_rows)
        for q, (which, times) in enumerate(queries):
            held = best[q]
            bar = held[-1][0] if len(held) == k else 0
            found, score = lists.best(which, times, k, bar)
            if len(found):
                held += zip(score.tolist(), ids.take(pa.array(found)).to_pylist())
                best[q] = sorted(held, key=order)[:k]
    flat = [(q, key, score) for q, held in enumerate(best) for score, key in held]
    if flat:
        q, key, score = zip(*flat)
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(key, kind),
                                          pa.array(score, pa.int64())], ["query", "id", "score"])


def _top(found: DataFrame, by: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(`item_col`, rank, `id_col`, score) of the `k` best documents by score
    for every row of `items`, scores above 0 only, equal scores by ascending id
    with nulls last.

    Every row of `docs` with a term is a document of its own, rows with null or
    repeated ids too; null and empty texts count nowhere. Items without a term
    have no rows; items that repeat an id each have their own. Ids keep their
    types; empty tables give an empty result; other columns are not read, and
    output names that `item_col` has taken get an underscore in front.
    """
    if k < 1:
        raise ValueError("k must be 1 or more")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    item_kind = items.schema[item_col].dataType
    spark, out = docs.sparkSession, None
    taken = [item_col]
    for c in ("rank", id_col, "score"):
        taken.append(fresh(c, taken))
    for block in _query_blocks(items, item_col, item_text, block_terms):
        vocabulary: dict[bytes, int] = {}
        queries = []
        for _, mine in block:
            which, times = np.unique([vocabulary.setdefault(t, len(vocabulary)) for t in mine],
                                     return_counts=True)
            queries.append((which, times))
        held = stored(_occurrences(rows, vocabulary), "lexical-occurrences")
        total, words = held.agg(F.count("*"), F.sum("n")).first()
        if not total:
            continue
        df = np.zeros(len(vocabulary), np.int64)
        for r in held.select(F.explode("term").alias("t")).groupBy("t").count().collect():
            df[r[0]] = r[1]  # at most as many as the block has terms
        weight = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * d + 1))) for d in df.tolist()],
                          np.int64)
        found = held.mapInArrow(
            lambda batches, a=(weight, queries, k, total, words): _search(batches, *a),
            f"query int, id {kind}, score long")
        grouped = _top(found.withColumn("of", F.spark_partition_id() % MERGE_GROUPS), ["query", "of"], k)
        top = _top(grouped.select("query", "id", "score"), ["query"], k)
        names = spark.createDataFrame([(q, key) for q, (key, _) in enumerate(block)],
                                      f"query int, item {item_kind.simpleString()}")
        part = top.join(names, "query").select(*[F.col(c).alias(a) for c, a in
                                                 zip(("item", "rank", "id", "score"), taken)])
        part = stored(part, "lexical-found")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], f"`{taken[0]}` {item_kind.simpleString()}, `{taken[1]}` int, "
                                         f"`{taken[2]}` {kind}, `{taken[3]}` long")
    return out
