"""Repeated passages across documents by content-defined chunking.

A text is its words (runs of bytes other than space and \\t..\\r) joined by
single spaces. A gear hash rolls over the bytes, h = (h << 4) + GEAR[byte]
modulo 2^64, so it depends on the last 16 bytes only. A word starts a new
chunk where the hash before it is below 2^64 / `mean_words`: the cuts of a
passage are its own, wherever it stands and whatever was inserted before it,
from its fourth word or so on. Chunks are compared by their 64-bit XXH3 digest.

A window is a series of whole neighbouring chunks of at least `min_words` words
that is not longer than it must be, counted from its first chunk on or from its
last one back. Windows are compared by the 64-bit XXH3 digest of their chunks'
digests, so one that repeats stands whole in one earlier document, and chunks
that repeat by chance, each in another document, do not add up. A window that
also occurs in a document with a smaller id is repeated; the document with the
smallest id keeps it. Repeated windows that overlap or adjoin are one span to
cut. As windows are taken from either side, a passage of whole chunks is covered
up to its last chunk. It loses about 3 words of sync and a part of a chunk at
either end, so with the defaults (chunks of 4 words, windows of 24) a passage of
50 words is found with probability 0.99, one of 60 with 0.999; the part outside
the whole chunks stays. A stretch of one word over and over has no cuts of its
own and is found by what surrounds it only.

Scale: one row of 3 longs per window, about 1.4 a chunk. Keepers come from a
map-side combined min/max per digest (hash aggregate); the repeated windows from
a join on the digest, whose hot keys adaptive execution splits, as the other side
has one row per digest. Only repeated windows are shuffled once more, by document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickguard.llm.common import fresh, map_texts, slabs, stored

#: Bytes that a hash depends on, and the shift a byte.
WINDOW, SHIFT = 16, 4
#: A chunk is also cut after so many words: a window is shorter than `min_words`
#: and a chunk together, which its packed length can hold.
MOST_WORDS = 2048
_PIECE = 1 << 20
_PLACE, _LENGTH = 40, 12  # bit offsets in the packed place of a window

#: byte -> random word; 0 for the byte that pads the start of a text
_GEAR = np.array([0] + [xxhash.xxh64_intdigest(bytes([b]), 7) for b in range(1, 256)], np.uint64)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash at every byte, by doubling the window."""
    h, w = _GEAR[data], 1
    while w < WINDOW:
        h[w:] += h[:-w] << np.uint64(SHIFT * w)
        w *= 2
    return h


def _text_hash(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0x7FFFFF


def chunks(data: bytes, mean_words: int = 4):
    """(first word, words, digest) arrays of the chunks of a text."""
    words = data.split()
    if not words:
        none = np.zeros(0, np.int64)
        return none, none, none
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    cut = np.zeros(len(words), bool)
    limit = np.uint64((1 << 64) // mean_words - 1)
    raw = np.frombuffer(joined, np.uint8)
    for lo in range(0, len(joined), _PIECE):  # bounded memory for a long text
        back = max(0, lo - WINDOW)
        h = gear(raw[back:lo + _PIECE])
        i, j = np.searchsorted(start - 1, [lo, lo + _PIECE])
        i = max(i, 1)  # the first word has no hash before it
        cut[i:j] = h[start[i:j] - 1 - back] <= limit
    cut[0] = True
    first = np.flatnonzero(cut)
    n = np.diff(np.r_[first, len(words)])
    if n.max() > MOST_WORDS:
        first = np.concatenate([np.arange(f, f + k, MOST_WORDS) for f, k in zip(first, n)])
        n = np.diff(np.r_[first, len(words)])
    return first, n, _digests(joined, start[first], end[first + n - 1])


def _digests(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    h64 = xxhash.xxh3_64_intdigest
    digest = np.fromiter((h64(data[a:b]) for a, b in zip(start.tolist(), end.tolist())),
                         np.uint64, len(start))
    return digest.view(np.int64)


def windows(data: bytes, mean_words: int = 4, min_words: int = 24):
    """(first word, words, digest) arrays of the windows of a text."""
    first, n, digest = chunks(data, mean_words)
    if not len(first):
        return first, n, digest
    stop, k = first + n, np.arange(len(first))
    on = np.searchsorted(stop, first + min_words, "left")
    back = np.searchsorted(first, stop - min_words, "right") - 1
    pair = np.unique(np.r_[(k * len(k) + on)[on < len(k)], (back * len(k) + k)[back >= 0]])
    i, j = pair // len(k), pair % len(k)
    return first[i], stop[j] - first[i], _digests(digest.tobytes(), 8 * i, 8 * j + 8)


def window_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 mean_words: int = 4, min_words: int = 24) -> DataFrame:
    """(id, at, digest) per window of the rows with an id; `at` packs a hash of
    the text, the first word's number and the number of words."""
    if not 1 <= min_words < 1 << _LENGTH - 1:
        raise ValueError(f"min_words must be from 1 to {(1 << _LENGTH - 1) - 1}")
    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for b in slabs(batches, "text"):
            of, at, digest = [], [], []
            for i, t in enumerate(b.column("text").to_pylist()):
                if not t:
                    continue
                data = t.encode("utf-8", "surrogatepass")
                first, n, d = windows(data, mean_words, min_words)
                of.append(np.full(len(n), i))
                at.append((_text_hash(data) << _PLACE) | (first << _LENGTH) | n)
                digest.append(d)
            if of:
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(np.concatenate(of))),
                     pa.array(np.concatenate(at)), pa.array(np.concatenate(digest))],
                    ["id", "at", "digest"])

    return map_texts(rows, run, f"id {kind}, at long, digest long")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   mean_words: int = 4, min_words: int = 24) -> DataFrame:
    """(`id_col`, text_hash, word_start, n_words, first_id) per passage to cut.

    first_id is the smallest document that keeps a part of the passage.
    text_hash tells apart texts that share an id; rows that repeat id and text
    share their spans, and a passage that repeats within one id only is left
    alone. Null ids and null or empty texts take no part. Empty tables give an
    empty result; other columns are not read.
    """
    rows = window_table(docs, id_col, text_col, mean_words, min_words)
    kept = (rows.groupBy("digest").agg(F.min("id").alias("keep"), F.max("id").alias("last"))
            .where("keep <> last").select("digest", "keep"))
    again = (rows.join(kept, "digest").where("id <> keep")
             .select("id", F.shiftright("at", _PLACE).alias("text_hash"),
                     F.shiftright("at", _LENGTH).bitwiseAND(F.lit((1 << _PLACE - _LENGTH) - 1))
                     .alias("start"),
                     F.col("at").bitwiseAND(F.lit((1 << _LENGTH) - 1)).alias("n"), "keep"))
    by_text = Window.partitionBy("id", "text_hash").orderBy("start", "n")
    steps = (again.withColumn("stop", F.col("start") + F.col("n"))
             .withColumn("before", F.max("stop").over(by_text.rowsBetween(Window.unboundedPreceding, -1)))
             .withColumn("run", F.sum(F.when(F.col("start") <= F.col("before"), 0).otherwise(1))
                         .over(by_text.rowsBetween(Window.unboundedPreceding, 0))))
    spans = (steps.groupBy("id", "text_hash", "run")
             .agg(F.min("start").alias("word_start"), (F.max("stop") - F.min("start")).alias("n_words"),
                  F.min("keep").alias("first_id")))
    out = "text_hash", "word_start", "n_words", "first_id"
    return spans.select(F.col("id").alias(id_col),
                        *[F.col(c).alias(fresh(c, [id_col])) for c in out])


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given (first word, words), each with the white
    space after it; spans do not overlap."""
    data = text.encode("utf-8", "surrogatepass")
    space = np.isin(np.frombuffer(data, np.uint8), [9, 10, 11, 12, 13, 32])
    start = np.flatnonzero(~space & np.r_[True, space[:-1]])
    at = np.r_[start, len(data)]
    out, done = [], 0
    for first, n in sorted(spans):
        out.append(data[done:at[first]])
        done = int(at[first + n])
    return b"".join([*out, data[done:]]).decode("utf-8", "surrogatepass")


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                mean_words: int = 4, min_words: int = 24) -> DataFrame:
    """`docs` with the repeated passages cut from its texts; rows whose text
    loses its last word go. All other rows and columns stay as they are."""
    spans = repeated_spans(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
                           "id", "text", mean_words, min_words)
    have = docs.columns
    ref, cuts, th = (fresh(c, have) for c in ("ref", "cuts", "text_hash"))
    per_doc = spans.groupBy(F.col("id").alias(ref)).agg(
        F.collect_list(F.struct("text_hash", "word_start", "n_words")).alias(cuts))
    # one pass: texts without cuts do not go through Python
    joined = docs.join(per_doc, F.col(id_col) == F.col(ref), "left")

    @F.pandas_udf("string")
    def cut(texts, lists):
        out = []
        for t, spans in zip(texts, lists):
            mine = []
            if t and spans is not None and len(spans):
                h = _text_hash(t.encode("utf-8", "surrogatepass"))
                mine = [(s["word_start"], s["n_words"]) for s in spans if s["text_hash"] == h]
            out.append(without_spans(t, mine) if mine else t)
        return texts.__class__(out, dtype=object)

    return _cut(joined, cut, cuts, th, have, text_col)


def _cut(joined: DataFrame, cut, cuts: str, made: str, have: list[str], text_col: str) -> DataFrame:
    """`have` of `joined` with the texts that `cut` makes of those that have
    `cuts`; rows whose text loses its last word go."""
    some = F.col(cuts).isNotNull()
    done = joined.withColumn(made, cut(F.when(some, F.col(text_col)), F.col(cuts)))
    new = F.coalesce(made, text_col)
    left = F.col(made).rlike(r"[^ \t-\r]") | F.col(made).eqNullSafe(F.col(text_col))
    return (done.where(~some | left)
            .select(*[new.alias(c) if c == text_col else F.col(c) for c in have]))


#: Bits of a place, and those that an id may take of them.
_PLACE_BITS, _ID_BITS = 61, 48


def with_places(docs: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """`docs` with a long that orders its rows by id, nulls last, and those
    that share an id, or have none, by a hash of their text; rows that repeat
    both have the same place."""
    whole = isinstance(docs.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    number = F.col(id_col).cast("long")
    low, high = docs.agg(F.min(number), F.max(number)).first() if whole else (None, None)
    if whole and (low is None or high - low < 1 << 40):
        low, bits, source = low or 0, ((high or 0) - (low or 0)).bit_length(), docs
    else:  # numbers in the order of the ids instead
        ref, number = fresh("id", docs.columns), fresh("number", docs.columns)
        ids = docs.select(F.col(id_col).alias(ref)).where(F.col(ref).isNotNull()).distinct().sort(ref)
        ids = stored(ids.withColumn(number, F.monotonically_increasing_id()), "substring-ids")
        low, bits = 0, (ids.agg(F.max(number)).first()[0] or 0).bit_length()
        if bits > _ID_BITS:
            raise ValueError(f"{bits} bits of ids: sort them in fewer partitions")
        source, number = docs.join(ids, F.col(id_col) == F.col(ref), "left").drop(ref), F.col(number)
    free = _PLACE_BITS - bits
    h = F.xxhash64(F.col(text_col).cast("string"))
    # by shifts, not products: Spark's arithmetic may raise on overflow, these fit
    first = F.shiftleft(number - F.lit(low), free).bitwiseOR(F.shiftrightunsigned(h, 64 - free))
    last = F.lit(1 << _PLACE_BITS).bitwiseOR(F.shiftrightunsigned(h, 64 - _PLACE_BITS))
    return source.select(*[F.col(c) for c in docs.columns],
                         F.when(F.col(id_col).isNull(), last).otherwise(first).alias(name))


def _digest_table(docs: DataFrame, place: str, text_col: str, mean_words: int, min_words: int) -> DataFrame:
    """(place, digest) per different window of every row."""

    def run(batches):
        for b in slabs(batches, "text"):
            n, digest = [], []
            for t in b.column("text").to_pylist():
                d = np.unique(windows(t.encode("utf-8", "surrogatepass"), mean_words, min_words)[2]) if t else ()
                n.append(len(d))
                digest.append(np.asarray(d, np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("place").take(pa.array(np.repeat(np.arange(len(n)), n))), pa.array(np.concatenate(digest))],
                ["place", "digest"])

    rows = docs.select(F.col(place).alias("place"), F.col(text_col).cast("string").alias("text"))
    return map_texts(rows, run, "place long, digest long")


def cut_later_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      mean_words: int = 4, min_words: int = 24) -> DataFrame:
    """`docs` with the passages cut that stand in an earlier row: one with a
    smaller id, or, of rows that share an id or have none, a smaller hash of the
    text; rows without an id come after all others. Rows that repeat id and text
    are cut alike and do not count as earlier than each other. Rows whose text
    loses its last word go; null and empty texts and all other columns stay as
    they are, an empty table empty.

    Windows cross the network as (place, digest): once to find the first place
    of each digest, once to find the others. A repeated digest goes to its rows,
    whose windows are made anew there, so positions do not travel.
    """
    have = docs.columns
    place, ref, cuts, made = (fresh(c, have) for c in ("place", "ref", "cuts", "made"))
    placed = with_places(docs, id_col, text_col, place)
    rows = _digest_table(placed, place, text_col, mean_words, min_words)
    kept = (rows.groupBy("digest").agg(F.min("place").alias("keep"), F.max("place").alias("last"))
            .where("keep <> last").select("digest", "keep"))
    again = rows.join(kept, "digest").where("place <> keep")
    per_row = again.groupBy(F.col("place").alias(ref)).agg(F.collect_set("digest").alias(cuts))
    joined = placed.join(per_row, F.col(place) == F.col(ref), "left")

    @F.pandas_udf("string")
    def cut(texts, digests):
        out = []
        for t, known in zip(texts, digests):
            if not t or known is None or not len(known):
                out.append(t)
                continue
            first, n, digest = windows(t.encode("utf-8", "surrogatepass"), mean_words, min_words)
            hit = np.isin(digest, np.asarray(known, np.int64))
            out.append(without_spans(t, _spans(first[hit], n[hit])))
        return texts.__class__(out, dtype=object)

    return _cut(joined, cut, cuts, made, have, text_col)


def _spans(first: np.ndarray, n: np.ndarray) -> list[tuple[int, int]]:
    """(first word, words) of what the windows cover, those that overlap or
    adjoin as one."""
    order = np.argsort(first, kind="stable")
    first, stop = first[order], np.maximum.accumulate((first + n)[order])
    new = np.flatnonzero(np.r_[True, first[1:] > stop[:-1]])
    return [(int(a), int(z - a)) for a, z in zip(first[new], stop[np.r_[new[1:] - 1, len(stop) - 1]])]
