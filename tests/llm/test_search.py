"""Operators 11 to 13: nearest neighbours, ranked lexical search, periodic runs."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickguard.llm import lexical, neighbours, queries, runs


def sorted_rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# --- nearest neighbours -------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int, score string"


def nearest(vectors, asked, k):
    """Brute force: {query: [(id, distance)]} over distinct (id, vector) pairs."""
    ok = {(i, v) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
          and any(v)}
    out = {}
    for q, v in ok:
        if q in asked:
            x = np.float32(v).astype(float)
            near = sorted((math.sqrt(((x - np.float32(w).astype(float)) ** 2).sum()), i)
                          for i, w in ok if (i, w) != (q, v) and len(w) == len(v))
            out[q] = [(i, d) for d, i in near[:k]]
    return out


def clustered(n, dim, clusters=20, seed=3):
    r = np.random.RandomState(seed)
    centre = r.standard_normal((clusters, dim)) * 2
    return (centre[r.randint(clusters, size=n)] + r.standard_normal((n, dim))).astype(np.float32)


def test_neighbours_recall_order_and_scores(spark):
    x = clustered(3000, 24)
    rows = spark.createDataFrame([(i, v.tolist(), 0, "x") for i, v in enumerate(x)], VECTORS)
    got = neighbours.nearest_neighbours(rows, rows.where("vec_id % 20 = 0")).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    found = 0
    for q in range(0, 3000, 20):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        d[q] = np.inf
        mine = sorted(by[q], key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        assert all(abs(d[r.vec_id] - r.score) < 1e-12 for r in mine)
        found += len({r.vec_id for r in mine} & set(np.argsort(d)[:10].tolist()))
    assert found >= 0.9 * 10 * 150


def test_neighbours_few_parts_of_clusters_suffice(spark):
    x = clustered(4000, 16, clusters=40)[np.random.RandomState(0).permutation(4000)]
    router, probes, recall = neighbours.fit(spark, x.astype(float), len(x), 10)
    parts = router.net[3].size
    assert parts == 64 and recall >= neighbours.TARGET and probes <= parts // 2


def test_balanced_parts_are_balanced_and_local(spark):
    x = clustered(1000, 8, clusters=8).astype(float)
    near = neighbours._graph(spark, x, x, 10)
    for parts in (2, 7, 16):
        label = neighbours.balanced_parts(x, near, parts)
        size = np.bincount(label, minlength=parts)
        assert size.max() - size.min() <= parts.bit_length()
        kept = (label[near] == label[:, None]).mean()
        assert kept > 3 / parts or kept > 0.6


def test_neighbours_copies_ties_nulls_and_lengths(spark):
    r = random.Random(5)
    some = [[float(r.randint(-2, 2)) for _ in range(3)] for _ in range(12)]
    rows = [(i, some[0] if i % 3 == 0 else r.choice(some)) for i in range(150)]
    rows += [(200, None), (201, [0.0] * 3), (202, [1.0, None, 0.0]), (203, [float("nan"), 1.0, 1.0]),
             (None, [1.0, 1.0, 1.0]), (204, [1.0, 2.0]), (205, [1.0, 2.5]), (206, [7.0]), (207, []),
             (20, rows[20][1]), (40, [9.0, 9.0, 9.0]), (208, [float("inf"), 1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECTORS)
    asked = {i for i, _ in rows if i is not None and (i % 20 == 0 and i != 40 or i > 200)}
    got = neighbours.nearest_neighbours(df, df.where(F.col("vec_id").isin(list(asked))), k=10, block_rows=3)
    by = {}
    for g in got.collect():
        by.setdefault(g.query_id, []).append((g["rank"], g.vec_id, g.score))
    want = nearest([(i, tuple(v) if v is not None else None) for i, v in rows], asked, 10)
    assert {q for q, w in want.items() if w} == set(by)
    for q, mine in by.items():
        assert [(i, pytest.approx(s, abs=1e-12)) for _, i, s in sorted(mine)] == want[q]
        assert [n for n, _, _ in sorted(mine)] == list(range(1, len(mine) + 1))
    assert set(got.columns) == {"query_id", "rank", "vec_id", "score"}


def test_neighbours_empty_and_names(spark):
    df = spark.createDataFrame([], VECTORS)
    assert neighbours.nearest_neighbours(df, df).collect() == []
    two = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.0])], "rank bigint, v array<double>")
    got = neighbours.nearest_neighbours(two, two, id_col="rank", vec_col="v", query_col="score")
    assert got.columns == ["score", "rank", "_rank", "_score"]
    assert sorted_rows(got, *got.columns) == [(1, 1, 2, 0.5), (2, 1, 1, 0.5)]


# --- ranked lexical search ----------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(docs, items, k):
    bags = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    total, words = len(bags), sum(len(b) for _, b in bags)
    df = {}
    for _, b in bags:
        for t in set(b):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            m = 100 - 25 + (25 * len(b) * total) // words
            s = 0
            for t in TERM.findall((text or "").translate(LOWER)):
                tf = b.count(t)
                if tf:
                    w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                    s += w * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def prose(r, vocabulary, n):
    return " ".join(r.choice(vocabulary) for _ in range(n))


@pytest.mark.parametrize("step", [1, 32])
def test_ranked_search_equals_brute_force(spark, monkeypatch, step):
    r = random.Random(step)
    vocabulary = [f"w{i}" for i in range(60) for _ in range(60 // (i + 1) + 1)]
    docs = [(i, prose(r, vocabulary, r.choice([1, 5, 20, 200]))) for i in range(400)]
    docs += [(500 + i, docs[7][1]) for i in range(60)]  # copies tie
    docs += [(600, None), (601, ""), (602, "... --- !"), (None, docs[3][1]), (5, docs[5][1]),
             (603, "W1 w1-W2_é É"), (604, "word " * 30_000 + "w3")]
    items = [(i, prose(r, vocabulary, r.choice([1, 4, 40]))) for i in range(20)]
    items += [(90, None), (91, " .. "), (92, "absent"), (0, "w1 w1 w1 é"), (None, "w2")]
    d = spark.createDataFrame([(a, b, 1, "x") for a, b in docs], "doc_id bigint, text string, rank int, item_id string")
    q = spark.createDataFrame([(a, b, 2) for a, b in items], "item_id bigint, text string, score int")
    monkeypatch.setattr(lexical, "FIRST_READ", step)
    for block in (lexical.BLOCK_TERMS, 100):
        got = lexical.ranked_search(d.repartition(5), q, block_terms=block)
        assert sorted_rows(got, "item_id", "rank", "doc_id", "score") == ranked(docs, items, 20)


def test_lists_stop_before_their_end():
    r = np.random.RandomState(1)
    doc = np.concatenate([r.permutation(4000) for _ in range(3)])
    term = np.repeat(np.arange(3), 4000)
    # documents that are good by one term are good by the others
    impact = (10**9 // (1 + doc) + r.randint(0, 1000, 12000)).astype(np.int64)
    lists = lexical.Lists(doc, term, impact, 3, 4000)
    seen = []
    whole = lists.impact
    lists.impact = Counted(whole, seen)
    found, score = lists.best(np.arange(3), np.array([1, 2, 1]), 10, 0)
    total = np.zeros(4000, np.int64)
    np.add.at(total, doc, impact * np.array([1, 2, 1])[term])
    best = sorted(zip(-score, found))[:10]
    assert [(-s, int(d)) for s, d in best] == [(int(total[d]), int(d)) for d in np.lexsort((np.arange(4000), -total))[:10]]
    assert len(set(np.concatenate(seen).tolist())) < 1000  # of 12,000 entries


class Counted:
    """An array that notes which entries are read."""

    def __init__(self, a, seen):
        self.a, self.seen = a, seen

    def __getitem__(self, i):
        self.seen.append(np.atleast_1d(i))
        return self.a[i]


def test_ranked_search_empty_and_names(spark):
    d = spark.createDataFrame([("a", "x y"), ("b", "x")], "item_id string, text string")
    q = spark.createDataFrame([(1, "x")], "item_id bigint, text string")
    got = lexical.ranked_search(d, q, id_col="item_id")
    assert got.columns == ["item_id", "rank", "_item_id", "score"]
    assert [(r[0], r[1], r[2]) for r in got.sort("rank").collect()] == [(1, 1, "b"), (1, 2, "a")]
    none = lexical.ranked_search(d.limit(0), q, id_col="item_id")
    assert none.columns == got.columns and none.collect() == []
    assert lexical.ranked_search(d, q.limit(0), id_col="item_id").collect() == []


# --- periodic runs ------------------------------------------------------------


def runs_of(w, least=4, shortest=6):
    found = []
    for q in range(1, len(w) // least + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j + q - i
            if n >= max(shortest, least * q) and not any(w[i:i + n - d] == w[i + d:i + n] for d in range(1, q)):
                found.append((i, n, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(w, found):
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in drop)


def repetitive(r):
    w = []
    for _ in range(r.randint(0, 12)):
        piece = [r.choice("abc") for _ in range(r.randint(1, 5))]
        w += piece * r.randint(1, 7) if r.random() < 0.6 else [f"u{r.randint(0, 99)}" for _ in range(5)]
    return w


@pytest.mark.parametrize("least,shortest", [(4, 6), (2, 2), (3, 1)])
def test_periodic_runs_equal_brute_force(spark, least, shortest):
    r = random.Random(least)
    docs = [(i, repetitive(r)) for i in range(150)]
    docs += [(None, ["a"] * 9), (3, ["b"] * 6), (200, ["é", "ß"] * 4), (201, ["x"] * 3000),
             (202, [str(i % 97) for i in range(2000)])]
    df = spark.createDataFrame([(i, r.choice([" ", "\n\t", " \r\x0b"]).join(w) + " ", 1) for i, w in docs],
                               "doc_id bigint, text string, runs int")
    got = runs.periodic_runs(df.repartition(4), min_exponent=least, min_length=shortest)
    mine = sorted(((g.doc_id, g.n_words, [tuple(x) for x in g.runs], g.collapsed) for g in got.collect()), key=repr)
    want = []
    for i, w in docs:
        found = runs_of(w, least, shortest)
        want.append((i, len(w), found, collapse(w, found)))
    assert mine == sorted(want, key=repr)


def test_periodic_runs_nulls_empty_and_names(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n "), (None, "a a a a a a"), (1, "a")],
                               "runs bigint, t string")
    got = runs.periodic_runs(df, "runs", "t")
    assert got.columns == ["runs", "n_words", "_runs", "collapsed"]
    assert sorted_rows(got, "runs", "n_words", "collapsed") == sorted(
        [(1, 0, ""), (2, 0, ""), (3, 0, ""), (None, 6, "a"), (1, 1, "a")], key=repr)
    assert runs.periodic_runs(df.limit(0), "runs", "t").collect() == []


def test_long_text_with_runs(spark):
    w = [f"v{i % 5000}" for i in range(100_000)] + ["z"] * 100_000
    df = spark.createDataFrame([(1, " ".join(w))], "doc_id bigint, text string")
    (g,) = runs.periodic_runs(df).collect()
    assert [tuple(x) for x in g.runs] == [(0, 100_000, 5000), (100_000, 100_000, 1)]
    assert g.collapsed == " ".join(w[:5000] + ["z"])


def test_parting_changes_nothing():
    r = random.Random(8)
    for _ in range(60):
        w = repetitive(r)
        ids = {x: i for i, x in enumerate(dict.fromkeys(w))}
        s = [ids[x] for x in w] + [len(ids)]
        whole = list(zip(*[a.tolist() for a in runs.string_runs(s, len(ids) + 1, 4, 6)])) if w else []
        assert whole == runs_of(w)


def test_op13_query_digests(spark, tmp_path):
    r = random.Random(2)
    docs = [(i, " ".join(repetitive(r)) if r.random() < 0.7 else prose(r, ["p", "q", "r", "s"], 60)) for i in range(200)]
    docs += [(1000, None), (1001, ""), (None, "a a a a a a")]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {g.doc_id: g for g in queries.op13_runs(spark, str(tmp_path)).collect()}
    looped = 0
    for i, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and w:
            looped += 1
            n, k = len(w), h // 10
            a = k % n
            p = 1 + (n - a) // (3 + k % 8)
            w = [w[a + (j - a) % p] if j >= a else w[j] for j in range(n)]
        found = runs_of(w)
        best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else None
        g = got[i]
        assert g.n_runs == len(found)
        assert (g.start, g.length, g.period) == (best or (None,) * 3)
        assert g.exponent_milli == (1000 * best[1] // best[2] if best else None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        assert g.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert g.collapsed_sha256 == hashlib.sha256(collapse(w, found).encode()).hexdigest()
    assert looped > 10
