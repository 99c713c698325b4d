"""Near-duplicate documents by SimHash fingerprints and pivot distance tables.

Fingerprint: A-Z lower-cased, words are runs of bytes other than space and
\\t..\\r, shingles are `shingle` consecutive words (repeats included) joined by
one space; bit i is 1 if more than half of the shingles' XXH64 (seed 42) have
it. Two fingerprints link at `max_bits` or fewer differing bits.

Finding the links, without loss and without all pairs:

1. Equal fingerprints are one class (map-side combined), so a group of exact
   copies of any size is one row from here on.
2. Pigeonhole keys bring linked classes together: the 64 bits are cut into
   max_bits + 3 blocks, of which at least 3 are equal in a linked pair, so the
   pair shares the bucket of some 3 blocks. Pivot coordinates alone offer no
   key to shuffle on (a window of +-4 in a distance to a random pivot keeps
   more than half of all fingerprints), hence the blocks.
3. In a bucket the pivot table does the discarding: the Hamming distances of
   each fingerprint to `PIVOTS` fixed reference fingerprints are computed once;
   by the triangle inequality a pair whose largest coordinate difference
   exceeds max_bits cannot link. The survivors are verified by their own
   distance.
4. A bucket gives a spanning forest of its links, not all pairs: fewer rows
   than fingerprints. A bucket of more than `bucket_rows` classes is not
   compared in one task: the bits in which its rows may differ are cut into
   max_bits + 1 blocks, of which a linked pair agrees on one, so each row goes
   on to max_bits + 1 buckets, one per block. Those that are still overfull are
   cut again, and only those, until at most `OPEN_BITS` bits are open: no such
   bucket can hold more than 2^OPEN_BITS fingerprints.

Components are then taken over the forest edges.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickguard.llm.common import fresh, map_texts, slabs, stored
from clickguard.llm.components import connected_components
from clickguard.llm.words import mixed

SEED = 42
PIVOTS = 16
#: Runs of up to so many rows are compared by vectors over the whole chunk.
SHORT_RUN = 8
CHUNK_ROWS = 200_000
BUCKET_ROWS = 20_000
#: A bucket whose rows may differ in no more bits is compared whatever its size.
OPEN_BITS = 13

#: byte value -> its 8 bits in the 8 byte lanes of a word
_LANES = np.array([sum(((v >> i) & 1) << (8 * i) for i in range(8)) for v in range(256)], np.uint64)


def _pivots(n: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(i.to_bytes(4, "little"), SEED) for i in range(n)], np.uint64)


def shingle_hashes(data: bytes, shingle: int) -> np.ndarray:
    words = data.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    n = max(1, len(words) - shingle + 1)
    first, last = (end - size)[:n].tolist(), end[min(shingle, len(words)) - 1:].tolist()
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(joined[i:j], SEED) for i, j in zip(first, last)), np.uint64, n)


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The unsigned fingerprint of one text; 0 without words."""
    h = shingle_hashes(text.encode("utf-8", "surrogatepass") if text else b"", shingle)
    if not len(h):
        return 0
    lanes = _LANES[h.view(np.uint8).reshape(-1, 8)]
    # at most 255 hashes a sum, so that no byte lane runs over
    part = np.add.reduceat(lanes, np.arange(0, len(h), 255), axis=0)
    ones = part.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 4) -> DataFrame:
    """(`id_col`, fp bigint) for every row of `docs`; a null or empty text
    has fingerprint zero. The bigint has the fingerprint's 64 bits."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for b in slabs(batches, "text"):
            fp = [fingerprint(t, shingle) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(np.array(fp, np.uint64).view(np.int64))], ["id", "fp"])

    return map_texts(rows, run, f"id {kind}, fp long").withColumnRenamed("id", id_col)


def block_masks(max_bits: int) -> list[int]:
    """Of each bucket family, the bits that its members share."""
    blocks = [sum(1 << int(i) for i in part) for part in np.array_split(np.arange(64), max_bits + 3)]
    return [sum(c) for c in combinations(blocks, 3)]


@lru_cache(maxsize=None)
def finer_masks(mask: int, max_bits: int) -> tuple[int, ...]:
    """`mask` with one more block each: of the max_bits + 1 blocks of the bits
    outside, two fingerprints that differ in max_bits of them agree on one."""
    rest = [i for i in range(64) if not mask >> i & 1]
    return tuple(mask | sum(1 << int(i) for i in part) for part in np.array_split(rest, max_bits + 1))


def _signed(m: int) -> int:
    return m - (1 << 64) if m >> 63 else m


class _Linker:
    """Spanning links of buckets; rows come sorted by bucket."""

    def __init__(self, max_bits: int, limit: int):
        self.max_bits, self.limit, self.pivots = max_bits, limit, _pivots(PIVOTS)

    def may_part(self, mask):
        """Whether a bucket of this mask can be cut finer."""
        return 64 - np.bitwise_count(mask).astype(int) > max(OPEN_BITS, self.max_bits)

    def near(self, x, dx, y, dy):
        """Pivot table first, then the distance itself."""
        ok = (np.abs(dx - dy) <= self.max_bits).all(axis=-1)
        at = np.flatnonzero(ok)
        return at[np.bitwise_count((x if x.ndim == 0 else x[at]) ^ y[at]) <= self.max_bits]

    def short(self, key, fp):
        """All links in runs of few rows, by the distance between rows."""
        table = np.bitwise_count(fp[:, None] ^ self.pivots).astype(np.int8)
        out = []
        for o in range(1, SHORT_RUN):
            i = np.flatnonzero(key[:-o] == key[o:])
            if not len(i):
                break
            hit = i[self.near(fp[i], table[i], fp[i + o], table[i + o])]
            out.append(np.stack([fp[hit], fp[hit + o]]))
        return out

    def long(self, fp):
        """A forest: each row is reached once, from the first that is near."""
        table = np.bitwise_count(fp[:, None] ^ self.pivots).astype(np.int8)
        left, ends, todo, out = np.arange(len(fp)), [], [], []
        while len(left):
            if not todo:
                todo.append(left[0])
                left = left[1:]
            i = todo.pop()
            at = self.near(fp[i], table[i], fp[left], table[left])
            if len(at):
                got = left[at]
                out.append(np.stack([np.full(len(got), fp[i]), fp[got]]))
                todo.extend(got.tolist())
                left = np.delete(left, at)
        return out

    def chunk(self, key, fp):
        """Links of whole buckets."""
        cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        size = np.diff(cut)
        few = np.repeat((size > 1) & (size <= SHORT_RUN), size)
        out = self.short(key[few], fp[few]) if few.any() else []
        for i in np.flatnonzero(size > SHORT_RUN):
            out += self.long(fp[cut[i]:cut[i + 1]])
        return np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.uint64)

    def __call__(self, batches):
        """Rows (mask, a, b): a link of two fingerprints (mask 0), or a bucket's
        key and a fingerprint of an overfull bucket with that mask."""
        key, fp, mask, full = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), None
        for more in self.chunks(batches):
            key, fp, mask = (np.r_[x, y] for x, y in zip((key, fp, mask), more))
            if full is not None:  # the rest of a bucket that goes on
                n = int(np.searchsorted(key != full, True))
                yield self.rows(mask[:n], key[:n], fp[:n])
                key, fp, mask = key[n:], fp[n:], mask[n:]
                full = full if not len(key) else None
            if len(key):
                n = int(np.flatnonzero(np.r_[True, key[1:] != key[:-1]])[-1])
                yield from self.whole(key[:n], fp[:n], mask[:n])
                key, fp, mask = key[n:], fp[n:], mask[n:]
                if len(key) > self.limit and self.may_part(mask[0]):
                    yield self.rows(mask, key, fp)
                    full, key, fp, mask = key[0], key[:0], fp[:0], mask[:0]
        yield from self.whole(key, fp, mask)

    @staticmethod
    def rows(mask, a, b):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.broadcast_to(np.asarray(mask, np.uint64), len(a)).view(np.int64)),
             pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["mask", "a", "b"])

    @staticmethod
    def chunks(batches):
        """The rows, about CHUNK_ROWS at a time."""
        parts, n = [], 0
        for b in batches:
            parts.append((b.column("k").to_numpy(), b.column("fp").to_numpy().view(np.uint64),
                          b.column("mask").to_numpy().view(np.uint64)))
            n += b.num_rows
            if n >= CHUNK_ROWS:
                yield [np.concatenate(x) for x in zip(*parts)]
                parts, n = [], 0
        if n:
            yield [np.concatenate(x) for x in zip(*parts)]

    def whole(self, key, fp, mask):
        if len(key):
            cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
            size = np.diff(cut)
            over = np.repeat((size > self.limit) & self.may_part(mask[cut[:-1]]), size)
            if over.any():
                yield self.rows(mask[over], key[over], fp[over])
                key, fp = key[~over], fp[~over]
        if len(key) > 1:
            yield self.rows(0, *self.chunk(key, fp))


def hamming_links(fps: DataFrame, max_bits: int = 4, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) of the distinct bigint fingerprints in `fps(fp)`: a subset
    of the pairs within `max_bits` bits that connects all that such pairs
    connect. An empty input gives no links."""
    # the family's number in the key keeps families apart; equal keys by
    # chance only cost comparisons, as every link is verified
    buckets = [F.struct(F.xxhash64(F.lit(f), F.col("fp").bitwiseAND(F.lit(m))).alias("k"), F.lit(m).alias("mask"))
               for f, m in enumerate(map(_signed, block_masks(max_bits)))]
    keyed = fps.select("fp", F.explode(F.array(*buckets)).alias("b")).select("b.k", "fp", "b.mask")

    def finer(batches):
        """Overfull rows under the keys of the next finer buckets: the bucket's
        own key and the bits of one more block."""
        for b in batches:
            mask, key, fp = (b.column(c).to_numpy().view(np.uint64) for c in ("mask", "a", "b"))
            known, at = np.unique(mask, return_inverse=True)
            next_masks = np.array([finer_masks(int(m), max_bits) for m in known], np.uint64)[at]
            which = np.arange(next_masks.shape[1], dtype=np.uint64)
            k = mixed(mixed((fp[:, None] & next_masks) + which) + key[:, None])
            yield pa.RecordBatch.from_arrays(
                [pa.array(k.ravel().view(np.int64)), pa.array(np.repeat(fp, len(which)).view(np.int64)),
                 pa.array(next_masks.ravel().view(np.int64))], ["k", "fp", "mask"])

    links = None
    while True:  # a few rounds at most: each leaves 1 / (max_bits + 1) fewer bits open
        found = stored(_linked(keyed, max_bits, bucket_rows), "simhash-links")
        new = found.where("mask = 0").select("a", "b")
        links = new if links is None else links.unionByName(new)
        over = found.where("mask <> 0")
        if over.isEmpty():
            return links
        keyed = over.mapInArrow(finer, "k long, fp long, mask long")


def _linked(keyed: DataFrame, max_bits: int, limit: int) -> DataFrame:
    return (keyed.repartition("k").sortWithinPartitions("k")
            .mapInArrow(_Linker(max_bits, limit), "mask long, a long, b long"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 4, max_bits: int = 4,
                       bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(`id_col`, fingerprint, component_id), one row per row of `docs`.

    fingerprint: 16 lower-case hex digits. component_id: the smallest id among
    the documents reachable over links, itself included. Null and empty texts
    have fingerprint zero and link like any other; a null id never names a
    component unless all ids in it are null; repeated rows stay repeated; an
    empty table gives an empty one; other columns are not read.
    """
    fps = stored(fingerprints(docs, id_col, text_col, shingle).withColumnRenamed(id_col, "id"),
                 "simhash-fp")
    classes = stored(fps.groupBy("fp").agg(F.min("id").alias("low")), "simhash-classes")
    nodes = connected_components(hamming_links(classes, max_bits, bucket_rows))
    labelled = (classes.join(nodes.withColumnRenamed("node", "fp"), "fp", "left")
                .select("fp", "low", F.coalesce("component", "fp").alias("component")))
    lowest = labelled.groupBy("component").agg(F.min("low").alias("component_id"))
    named = labelled.join(lowest, "component").select("fp", "component_id")
    out = fresh("component_id", [id_col])
    return (fps.join(named, "fp")
            .select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("component_id").alias(out)))
