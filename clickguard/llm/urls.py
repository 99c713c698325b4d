"""URL filters: prefix rules, and gradient-boosted trees on lexical features
for what no rule fits.

The rules label the URLs they fit; the trees (Spark ML) learn from those and
judge the rest. Inputs of the trees are lengths, depth, digit ratio, entropy,
parameter counts and statistics of the host's last label, its last two labels and
the path's first segment: how often each occurs in the whole table, and how many
of its labelled URLs are blocked. Hosts are dealt into `FOLDS` folds, and that
share is counted over the other folds' hosts only, so no URL's own label, nor one
of its host's, is in its features; with few labels it is drawn to the share in
the whole table. The trees are fitted on a sample of about `train_rows` labelled
rows, chosen by hash, of all folds but one. All labelled rows of that one, hosts
the trees have not seen, choose the score from which a URL is blocked: the one
that judges most of them right.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickguard.llm.common import fresh, stored

ALLOW, BLOCK = "allow", "block"
#: Labelled URLs that the trees are fitted on, about.
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 16, 4, 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RATE_PRIOR = 10.0
#: Folds of hosts, the last of which is held out, and steps of the threshold.
FOLDS, GRID = 5, 1000


def host_and_path(url) -> tuple[F.Column, F.Column]:
    """Host: after the first :// up to / ? # or the end, A-Z lower-cased;
    path: from there up to ? # or the end. Both empty without ://."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_column(host, path, rules: list[tuple[str, str, str]]) -> tuple[F.Column, F.Column]:
    """(rule, verdict) of the longest rule (verdict, host, path) that fits, of
    equally long ones the first by text; null without one."""
    rule = verdict = F.lit(None).cast("string")
    # the longest last, so that it is tested first
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def lexical(url: str | None, host: str, path: str) -> list[float]:
    """The features of one URL that its text alone gives."""
    url = url or ""
    n = max(1, len(url))
    counts = np.unique(list(url), return_counts=True)[1] / n if url else np.ones(1)
    runs = re.findall(r"[0-9]+", url)
    query = url.partition("#")[0].partition("?")[2]
    labels = host.split(".") if host else []
    segments = [s for s in path.split("/") if s]
    return [
        float(len(url)), float(len(host)), float(len(path)),
        float(len(segments)), float(len(labels)),
        sum(map(len, runs)) / n, float(max(map(len, runs), default=0)),
        float(-(counts * np.log2(counts)).sum()),
        float(len([p for p in query.split("&") if p])), float("#" in url),
        float(sum(url.count(c) for c in "-_%")), float("@" in host or ":" in host),
        float(bool(re.search(r"\.[A-Za-z0-9]{1,5}$", path))), float(path.endswith("/")),
        float(url.startswith("https:")), float(len(segments[0]) if segments else 0),
        max(map(len, labels), default=0) / max(1, len(host)),
    ]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _lexical(url: pd.Series, host: pd.Series, path: pd.Series) -> pd.Series:
    return pd.Series([lexical(*r) for r in zip(url, host, path)], dtype=object)


def _with_statistics(rows: DataFrame, key: str, name: str, base: float) -> DataFrame:
    """Adds the array `name`: log of the rows that share the value of `key`, and
    the smoothed share of their labelled rows on hosts of other folds that are
    blocked. Counted over all rows, map-side, into one row per value."""
    folds = [F.col("fold") != f for f in range(FOLDS)]
    stats = rows.groupBy(F.col(key).alias("key")).agg(
        F.count("*").alias("n"),
        F.array(*[F.count(F.when(other, F.col("label"))) for other in folds]).alias("known"),
        F.array(*[F.sum(F.when(other, F.col("label"))) for other in folds]).alias("bad"))
    joined = rows.join(stats, rows[key] == stats["key"])
    known, bad = (F.get(c, F.col("fold")) for c in ("known", "bad"))
    rate = (F.coalesce(bad, F.lit(0.0)) + F.lit(base * _RATE_PRIOR)) / (known + F.lit(_RATE_PRIOR))
    return joined.select(*rows.columns, F.array(F.log1p("n"), rate).alias(name))


def featured(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str, url_col: str) -> DataFrame:
    """(id, host, path, rule, given, label, fold, h, x) per row of `pages`:
    label is 1 where a rule blocks, 0 where one allows; x are the features."""
    host, path = host_and_path(F.col("url"))
    rows = (pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
            .withColumn("host", host).withColumn("path", path))
    rule, verdict = rule_column(F.col("host"), F.col("path"), rules)
    rows = (rows.withColumn("rule", rule).withColumn("given", verdict)
            .withColumn("label", F.when(F.col("given").isNotNull(), F.col("given") == BLOCK).cast("double"))
            .withColumn("fold", F.pmod(F.xxhash64("host", F.lit(SEED)), F.lit(FOLDS)).cast("int"))
            .withColumn("last", F.substring_index("host", ".", -1))
            .withColumn("domain", F.substring_index("host", ".", -2))
            .withColumn("section", F.regexp_extract("path", "^/*([^/]*)", 1)))
    base = rows.agg(F.avg("label")).first()[0] or 0.0
    for name, key in (("s1", "last"), ("s2", "domain"), ("s3", "section")):
        rows = _with_statistics(rows, key, name, base)
    x = F.concat(_lexical("url", "host", "path"), "s1", "s2", "s3")
    return rows.select("id", "host", "path", "rule", "given", "label", "fold",
                       F.xxhash64("url", "id").alias("h"), x.alias("x"))


def _threshold(cells) -> tuple[float, float | None]:
    """(threshold, accuracy) from (score in steps, rows, of them blocked): the
    score from which to block so that most rows are judged right, the highest
    of several; one half without rows."""
    if not cells:
        return 0.5, None
    step, n, bad = np.array(sorted(cells), float).T
    # blocked from step i on: the blocked ones there, and the allowed ones below
    right = np.r_[np.cumsum(bad[::-1])[::-1], 0] + np.r_[0, np.cumsum(n - bad)]
    best = int(np.flatnonzero(right == right.max())[-1])
    edge = step[best] if best < len(step) else GRID + 1
    return float((edge - 0.5) / GRID), float(right[best] / n.sum())


def scored(rows: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[DataFrame, float, float | None]:
    """(`rows` of `featured` with the trees' probability `p`, threshold,
    accuracy on the labelled URLs of held-out hosts, None if there are none)."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    held = F.col("fold") == FOLDS - 1
    labelled = rows.where(F.col("label").isNotNull())
    kinds = {r["label"]: r["n"] for r in labelled.where(~held).groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(kinds) < 2:
        return rows.withColumn("p", F.lit(0.0)), 0.5, None
    share = min(1.0, train_rows / sum(kinds.values()))
    mine = F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    known = stored(labelled.where(~held & mine).select("label", "x").repartition(6), "url-training")
    model = GBTClassifier(labelCol="label", featuresCol="v", maxIter=TREES, maxDepth=DEPTH, seed=SEED,
                          stepSize=0.3).fit(known.select("label", array_to_vector("x").alias("v")))
    out = (model.transform(rows.withColumn("v", array_to_vector("x")))
           .withColumn("p", vector_to_array("probability")[1]).drop("v", "rawPrediction", "probability", "prediction"))
    cells = (out.where(held & F.col("label").isNotNull()).groupBy(F.round(F.col("p") * GRID).alias("step"))
             .agg(F.count("*"), F.sum("label")).collect())  # a row per step at most
    return out, *_threshold([tuple(c) for c in cells])


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id",
          url_col: str = "url", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(`id_col`, host, path, rule, verdict, block_score, threshold) per row.

    verdict is the rule's, else "block" where the trees' probability
    (block_score, null where a rule decides) is the threshold or more, else
    "allow". A null url, or one without ://, has an empty host and path, fits no
    rule and is judged by the trees like any other. Where the rules don't label
    both kinds there is nothing to learn, and all others are allowed (score 0).
    Null ids and repeated rows stay; an empty table gives an empty one; other
    columns are not read.
    """
    rows = stored(featured(pages, rules, id_col, url_col), "url-features")
    score, least, _ = scored(rows, train_rows)
    judged = F.when(F.col("p") >= least, BLOCK).otherwise(ALLOW)
    out = [fresh(c, [id_col]) for c in ("host", "path", "rule", "verdict", "block_score", "threshold")]
    return score.select(
        F.col("id").alias(id_col), F.col("host").alias(out[0]), F.col("path").alias(out[1]),
        F.col("rule").alias(out[2]), F.coalesce("given", judged).alias(out[3]),
        F.when(F.col("given").isNull(), F.col("p")).alias(out[4]), F.lit(least).alias(out[5]))
