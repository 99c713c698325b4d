"""Quality scores: random Fourier features of document statistics, ridge
regression by partition-summed normal equations, isotonic calibration.

One pass over the texts turns each into `N_STATS` numbers; everything after
reads that small table. The ridge fit sums phi(x) phi(x)^T and phi(x) y per
partition (one row of a fixed size each), adds them in `SUMMERS` streaming
tasks and solves the small system on the driver. Calibration pools scores on a
grid of `GRID` steps a unit, so what reaches the driver has a fixed size too.
Only statistics of the text are inputs of a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickguard.llm.common import fresh, map_texts, slabs, stored

FOURIER = 256
RIDGE = 1e-3
SEED = 9
SUMMERS = 16
GRID = 1000
#: Standardised statistics are cut to this many deviations.
CLIP = 4.0

_ASCII = np.arange(256)
_CLASSES = {
    "letter": ((_ASCII | 32) >= 97) & ((_ASCII | 32) <= 122) | (_ASCII >= 128),
    "upper": (_ASCII >= 65) & (_ASCII <= 90),
    "digit": (_ASCII >= 48) & (_ASCII <= 57),
    "space": np.isin(_ASCII, [9, 10, 11, 12, 13, 32]),
    "newline": _ASCII == 10,
    "stop": np.isin(_ASCII, list(b".!?")),
    "comma": np.isin(_ASCII, list(b",;:")),
    "shout": _ASCII == ord("!"),
    "bar": _ASCII == ord("|"),
    "markup": np.isin(_ASCII, list(b"<>{}[]\\/=_`~^")),
    "symbol": np.isin(_ASCII, list(b"#$%&*@+")),
    "quote": np.isin(_ASCII, list(b"\"'()-")),
    "high": _ASCII >= 128,
}
_TABLE = np.stack(list(_CLASSES.values())).astype(np.float64)
N_STATS = len(_CLASSES) + 11
_WORD_END = re.compile(rb"[^A-Za-z0-9\x80-\xff]{2,}$")


def statistics(text: str | None) -> np.ndarray:
    """The statistics of one text; zeros without words."""
    data = text.encode("utf-8", "surrogatepass") if text else b""
    words = data.split()
    if not words:
        return np.zeros(N_STATS)
    hist = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = np.sqrt(_TABLE @ hist / len(data))  # spreads small shares
    p = hist[hist > 0] / len(data)
    size = np.fromiter(map(len, words), np.float64, len(words))
    lines = [x for x in data.split(b"\n") if x.strip()]
    kinds = set(words)
    ragged_end = sum(map(bool, map(_WORD_END.search, words)))
    return np.r_[share, [
        np.log1p(len(words)), np.log1p(len(lines)), size.mean(), size.std(),
        (size <= 3).mean(), (size >= 12).mean(), len(kinds) / len(words),
        len(kinds) / np.sqrt(len(words)), 1 - len(set(lines)) / len(lines),
        -(p * np.log2(p)).sum(), np.sqrt(ragged_end / len(words))]]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        row_col: str | None = None) -> DataFrame:
    """(id, x) per row: x holds the statistics as doubles in a binary; with
    `row_col` (id, row, x)."""
    keys = {"id": id_col} | ({"row": row_col} if row_col else {})
    rows = docs.select(*[F.col(c).alias(k) for k, c in keys.items()],
                       F.col(text_col).cast("string").alias("text"))
    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches):
        for b in slabs(batches, "text"):
            x = [statistics(t).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*map(b.column, keys), pa.array(x, pa.binary())], [*keys, "x"])

    return map_texts(rows, run, f"{kinds}, x binary")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(-1, N_STATS)


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    coef: np.ndarray | None = None
    grid: np.ndarray | None = None  # raw scores, ascending
    level: np.ndarray | None = None  # their calibrated scores

    def features(self, x: np.ndarray) -> np.ndarray:
        """cos(w.x + b): inner products approximate a Gaussian kernel of
        width sqrt(N_STATS) over the standardised statistics."""
        r = np.random.RandomState(SEED)
        w = r.standard_normal((N_STATS, FOURIER)) / np.sqrt(N_STATS)
        b = r.uniform(0, 2 * np.pi, FOURIER)
        z = np.clip((x - self.mean) / self.scale, -CLIP, CLIP)
        return np.c_[np.sqrt(2 / FOURIER) * np.cos(z @ w + b), np.ones(len(z))]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.coef if self.coef is not None else np.full(len(x), 0.5)

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        if self.grid is not None:
            raw = np.interp(raw, self.grid, self.level)
        return np.clip(raw, 0.0, 1.0)


def _summed(rows: DataFrame, each, size: int) -> np.ndarray | None:
    """Sum over all rows of `each(x, y)`, an array of `size` numbers: per
    partition, then in SUMMERS streaming tasks, then on the driver."""

    def emit(total):
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["v"])

    def part(batches):
        total = None
        for b in batches:
            if b.num_rows:
                v = each(_matrix(b.column("x").to_pylist()), b.column("y").to_numpy())
                total = v if total is None else total + v
        yield from emit(total)

    def add(batches):
        total = None
        for b in batches:
            for v in b.column("v"):
                v = np.frombuffer(v.as_buffer(), np.float64)
                total = v.copy() if total is None else total + v
        yield from emit(total)

    got = rows.mapInArrow(part, "v binary").repartition(SUMMERS).mapInArrow(add, "v binary").collect()
    return sum(np.frombuffer(r.v, np.float64) for r in got) if got else None


def isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray):
    """Pool adjacent violators: (x, fitted) of the non-decreasing weighted
    least-squares fit to mean y over n rows at ascending x."""
    blocks = []  # [sum of y, weight, first x, last x]
    for xi, yi, ni in zip(x, y, n):
        blocks.append([yi * ni, ni, xi, xi])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, w, _, last = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += w
            blocks[-1][3] = last
    grid = np.array([v for b in blocks for v in b[2:]], float)
    level = np.array([b[0] / b[1] for b in blocks for _ in (0, 1)])
    return grid, level


def fit_quality(training: DataFrame, calibration: DataFrame) -> QualityModel:
    """The model of labelled statistics (x binary, y double of 0 or 1). No
    training rows give scores of 0.5, no calibration rows uncalibrated ones."""
    n = N_STATS
    sums = _summed(training, lambda x, y: np.r_[len(x), x.sum(0), (x * x).sum(0)], 1 + 2 * n)
    if sums is None:
        return QualityModel(np.zeros(n), np.ones(n))
    mean = sums[1:1 + n] / sums[0]
    var = np.maximum(sums[1 + n:] / sums[0] - mean ** 2, 0)
    model = QualityModel(mean, np.where(var > 1e-12, np.sqrt(var), 1.0))
    d = FOURIER + 1

    def normal(x, y, m=model):
        phi = m.features(x)
        return np.r_[(phi.T @ phi).ravel(), phi.T @ y]

    eq = _summed(training, normal, d * d + d)
    model.coef = np.linalg.solve(eq[:d * d].reshape(d, d) + RIDGE * sums[0] * np.eye(d), eq[d * d:])

    def grid(frames, m=model):
        for f in frames:
            raw = np.clip(m.raw(_matrix(f["x"])), -1, 2) if len(f) else np.zeros(0)
            yield pd.DataFrame({"g": np.rint(raw * GRID).astype(np.int64), "y": f["y"].astype(float)})

    cells = (calibration.mapInPandas(grid, "g long, y double").groupBy("g")
             .agg(F.count("*").alias("n"), F.avg("y").alias("y")).orderBy("g").collect())
    if cells:
        g, k, y = (np.array([c[f] for c in cells], float) for f in ("g", "n", "y"))
        model.grid, model.level = isotonic(g / GRID, y, k)
    return model


def held_out(id_col) -> F.Column:
    """crc32(id as text) mod 4 is 2; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "quality",
                   threshold: float = 0.7, row_col: str | None = None) -> DataFrame:
    """(`id_col`, held_out, score, predicted) per row of `docs`; `row_col`, a
    column that tells rows apart, is passed on after the id.

    Labels are learnt from the rows of `labels` with a 0 or 1 whose id isn't
    held out: remainders 0 and 1 of crc32(id) mod 4 fit the ridge, remainder 3
    calibrates. Null or empty texts have statistics of zero and are scored like
    any other; a null id has no label and isn't held out; repeated rows stay;
    repeated labels count each; empty tables give empty results, or 0.5 each
    without labels. Other columns are not read.
    """
    stats = stored(document_statistics(docs, id_col, text_col, row_col), "quality-stats")
    y = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
         .select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
         .where(~held_out("id")))
    known = stored(stats.join(y, "id").select(
        "x", "y", (F.crc32(F.col("id").cast("string")) % 4).alias("fold")), "quality-known")
    model = fit_quality(known.where("fold < 2").select("x", "y"),
                        known.where("fold = 3").select("x", "y"))
    keys = ["id", "row"] if row_col else ["id"]
    kinds = ", ".join(f"{k} {stats.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches):
        for b in batches:
            s = model.score(_matrix(b.column("x").to_pylist())) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*map(b.column, keys), pa.array(s)], [*keys, "score"])

    names = [id_col, row_col] if row_col else [id_col]
    out = [fresh(c, names) for c in ("held_out", "score", "predicted")]
    return (stats.mapInArrow(run, f"{kinds}, score double")
            .select(*[F.col(k).alias(c) for k, c in zip(keys, names)], held_out("id").alias(out[0]),
                    F.col("score").alias(out[1]),
                    F.when(F.col("score") >= threshold, 1).otherwise(0).alias(out[2])))
