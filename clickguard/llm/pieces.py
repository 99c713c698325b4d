"""SentencePiece encoding and decoding by a batched numpy Viterbi.

A text is cut into words that the vocabulary cannot join (before each run of
U+2581 marks, around each unknown character); the distinct words of a slab,
found by 64-bit hash, are grouped by length and equal-length words advance
together, one character a step. At a step the substrings that end there, of
every length up to the longest piece, are hashed by differences of running
sums and probed in the sorted piece keys; the best predecessor of each word is
kept as a backpointer.

Two kinds of model, as the model file says:

- unigram: the best sum of piece scores.
- bpe: merges are greedy by score, so the best sum is not the library's
  result. A token sequence is the merges' result if and only if each
  neighbouring pair is what the merges leave of its two pieces, and such a
  sequence of a prefix is unique; so a piece may follow the best last piece
  of the shorter prefix only if that pair stands. Pairs are judged once (two
  replayed merge orders, see `_stands`) and remembered.

Results equal those of the sentencepiece library. Supported are models with the
identity normaliser that keep extra white space and have no user-defined or
unused pieces; others raise ValueError. No shuffle; memory is bounded by the
slab, the longest text and the caches' limits.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickguard.llm.common import fresh, map_texts, ragged, slabs
from clickguard.llm.words import mixed

MARK = "▁"
UNIGRAM, BPE = 1, 2
SLAB_BYTES = 1 << 20
#: Words whose pieces a task remembers, and pairs judged.
CACHED_WORDS, CACHED_PAIRS = 400_000, 1_000_000
#: Rows x lengths of a Viterbi step.
STEP_CELLS = 1 << 19
_NEVER = 1 << 40
_UNKNOWN_PENALTY = 10.0

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, _U)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def merge_order(word: str, rank: dict[str, int]) -> tuple[list[str], list]:
    """Greedy merges of `word` by lowest rank, leftmost first: the symbols left,
    and per merge (rank, first symbol, last symbol before it)."""
    sym, nxt, prv = list(word), list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
    alive, steps = [True] * len(sym), []
    first = 0
    last = len(sym) - 1
    heap = [(rank[a + b], i, a, b) for i, (a, b) in enumerate(zip(sym, sym[1:])) if a + b in rank]
    heapify(heap)
    while heap:
        r, i, a, b = heappop(heap)
        j = nxt[i] if alive[i] else -1
        if j < 0 or j >= len(sym) or sym[i] != a or sym[j] != b:
            continue
        steps.append((r, sym[first], sym[last]))
        sym[i] = a + b
        alive[j] = False
        nxt[i] = nxt[j]
        if nxt[j] < len(sym):
            prv[nxt[j]] = i
        if j == last:
            last = i
        for x, y in ((prv[i], i), (i, nxt[i])):
            if x >= 0 and y < len(sym) and sym[x] + sym[y] in rank:
                heappush(heap, (rank[sym[x] + sym[y]], x, sym[x], sym[y]))
    return [s for s, ok in zip(sym, alive) if ok], steps


class Vocabulary:
    """What encoding and decoding need of a model file: a few MB, sent whole
    to every task."""

    def __init__(self, model_path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(model_path, "rb") as f:
            proto.ParseFromString(f.read())
        kinds = proto.SentencePiece
        norm, self.kind = proto.normalizer_spec, proto.trainer_spec.model_type
        odd = {p.type for p in proto.pieces} & {kinds.USER_DEFINED, kinds.UNUSED}
        if (norm.precompiled_charsmap or norm.remove_extra_whitespaces or odd
                or not norm.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix
                or self.kind not in (UNIGRAM, BPE)):
            raise ValueError(f"{model_path}: not a kind of model that is supported")
        self.prefix = norm.add_dummy_prefix
        text = [p.piece for p in proto.pieces]
        normal = [i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL]
        if any(MARK in text[i].lstrip(MARK) for i in normal):
            raise ValueError(f"{model_path}: pieces go beyond words")
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN)
        byte = {int(text[i][1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        self.bytes = np.array([byte[b] for b in range(256)], np.int32) if len(byte) == 256 else None
        self.longest = max(len(text[i]) for i in normal)
        self.known = np.zeros(0x110000, bool)
        self.known[[ord(text[i]) for i in normal if len(text[i]) == 1]] = True
        if not all(self.known[ord(c)] for i in normal for c in text[i]):
            raise ValueError(f"{model_path}: pieces with unknown characters")
        self.score = np.array([p.score for p in proto.pieces])
        self.steps: dict[int, list] = {}
        if self.kind == BPE:
            order = sorted(normal, key=lambda i: -proto.pieces[i].score)
            self.rank = {text[i]: r for r, i in enumerate(order)}
            usable = []
            for i in normal:
                left, steps = merge_order(text[i], self.rank)
                if len(left) == 1:  # else the merges never give this piece
                    usable.append(i)
                    self.steps[i] = [*steps, (_NEVER, text[i], text[i])]
            normal = usable
        power, _ = _powers(self.longest + 1)
        key = np.array([self._key(text[i], power) for i in normal], _U)
        at = np.argsort(key)
        self.keys, self.ids = key[at], np.array(normal, np.int32)[at]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.keys >> _U(44)).astype(np.int64)] = True
        raw = []
        for p in proto.pieces:
            if p.type == kinds.BYTE:
                raw.append(bytes([int(p.piece[1:-1], 16)]))
            elif p.type == kinds.CONTROL:
                raw.append(b"")
            elif p.type == kinds.UNKNOWN:
                raw.append(" ⁇ ".encode())
            else:
                raw.append(p.piece.replace(MARK, " ").encode())
        self.pool = np.frombuffer(b"".join(raw), np.uint8)
        self.size = np.array([len(r) for r in raw])
        self.start = np.cumsum(self.size) - self.size

    @staticmethod
    def _key(piece: str, power: np.ndarray) -> int:
        h = sum((ord(c) + 1) * int(p) for c, p in zip(piece, power)) & ((1 << 64) - 1)
        return int(mixed(np.array([h], _U) + _U(len(piece)))[0])


def _stands(left: list, right: list, rank: dict[str, int]) -> bool:
    """Whether merges of two pieces' text leave the two pieces: their own
    merges are replayed in order, and no pair across is due before."""
    i = j = 0
    while True:
        (p, _, edge), (q, start, _) = left[i], right[j]
        across = rank.get(edge + start, _NEVER)
        if across < p and across <= q and across != _NEVER:
            return False  # of equal ranks the leftmost pair merges
        if p == q == _NEVER:
            return True
        if p <= q:
            i += 1
        else:
            j += 1


class Codec:
    """Encodes and decodes within a task; remembers words and pairs."""

    def __init__(self, vocab: Vocabulary):
        self.v = vocab
        self.power, self.inverse = _powers(1 << 16)
        self.pair_key, self.pair_ok = np.zeros(0, np.int64), np.zeros(0, bool)
        self._forget()

    def _forget(self):
        self.word_key, self.word_at = np.zeros(0, _U), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    # words

    def _segments(self, cp: np.ndarray, text_start: np.ndarray):
        """First characters of the words of concatenated texts."""
        mark = cp == ord(MARK)
        odd = ~self.v.known[cp]
        new = np.zeros(len(cp), bool)
        new[1:] = mark[1:] & ~mark[:-1] | odd[:-1] & ~odd[1:] | odd[1:] & (
            True if self.v.bytes is not None else ~odd[:-1])
        new[text_start] = True
        return np.flatnonzero(new), odd

    def encode(self, texts: list[str]):
        """(ids, tokens of each text)."""
        texts = [(MARK if self.v.prefix and t else "") + t.replace(" ", MARK) for t in texts]
        size = np.array([len(t) for t in texts], np.int64)
        begin = np.cumsum(size) - size
        cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        if not len(cp):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        start, odd = self._segments(cp, begin[size > 0])
        length = np.diff(np.r_[start, len(cp)])
        if len(cp) >= len(self.power):
            self.power, self.inverse = _powers(2 * len(cp))
        total = np.r_[_U(0), np.cumsum((cp.astype(_U) + _U(1)) * self.power[:len(cp)])]
        key = mixed((total[start + length] - total[start]) * self.inverse[start] + length.astype(_U))
        uniq, where, back = np.unique(key, return_index=True, return_inverse=True)
        at = self._word_rows(uniq, cp, start[where], length[where], odd)[back]
        n = self.count[at]
        ids = self.pool[ragged(self.first[at], n)]
        per_word = np.r_[0, np.cumsum(n)]
        edge = np.searchsorted(start, np.r_[begin, len(cp)])
        return ids, np.diff(per_word[edge])

    def _word_rows(self, key, cp, start, length, odd):
        """Rows of first/count for distinct words; new ones are encoded."""
        if len(self.word_key) > CACHED_WORDS:
            self._forget()
        at = np.searchsorted(self.word_key, key)
        at[at == len(self.word_key)] = 0
        new = np.ones(len(key), bool)
        if len(self.word_key):
            new = self.word_key[at] != key
        rows = np.zeros(len(key), np.int64)
        rows[~new] = self.word_at[at[~new]] if len(self.word_key) else 0
        if new.any():
            row = np.flatnonzero(new)
            ids, count = self._encode_words(cp, start[row], length[row], odd)
            rows[row] = len(self.first) + np.arange(len(row))
            self.first = np.r_[self.first, len(self.pool) + np.cumsum(count) - count]
            self.count = np.r_[self.count, count]
            self.pool = np.r_[self.pool, ids]
            keys = np.r_[self.word_key, key[row]]
            order = np.argsort(keys, kind="stable")
            self.word_key, self.word_at = keys[order], np.r_[self.word_at, rows[row]][order]
        return rows

    def _encode_words(self, cp, start, length, odd):
        """(ids, tokens of each word) in the order given."""
        parts: list = []  # (row, ids, count) blocks
        strange = odd[start]
        for i in np.flatnonzero(strange):
            if self.v.bytes is None:
                ids = np.array([self.v.unknown], np.int32)
            else:
                raw = chr(cp[start[i]]).encode("utf-8", "surrogatepass")
                ids = self.v.bytes[np.frombuffer(raw, np.uint8)]
            parts.append((np.array([i]), ids, np.array([len(ids)])))
        plain = np.flatnonzero(~strange)
        by_length = plain[np.argsort(length[plain], kind="stable")]
        cuts = np.flatnonzero(np.diff(length[by_length])) + 1
        for group in np.split(by_length, cuts) if len(by_length) else []:
            size = int(length[group[0]])
            block = max(1, STEP_CELLS // (self.v.longest + size))
            for lo in range(0, len(group), block):
                rows = group[lo:lo + block]
                ids, count = self._viterbi(cp[start[rows][:, None] + np.arange(size)])
                parts.append((rows, ids, count))
        if not parts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        row = np.concatenate([p[0] for p in parts])
        ids = np.concatenate([p[1] for p in parts])
        count = np.concatenate([p[2] for p in parts])
        first = np.cumsum(count) - count
        order = np.argsort(row)
        return ids[ragged(first[order], count[order])], count[order]

    def _viterbi(self, words: np.ndarray):
        """(ids, tokens of each row) of words of one length."""
        v, (n, size) = self.v, words.shape
        if size >= len(self.power):
            self.power, self.inverse = _powers(2 * size)
        total = np.zeros((n, size + 1), _U)
        np.cumsum((words.astype(_U) + _U(1)) * self.power[:size], axis=1, out=total[:, 1:])
        piece = np.full((n, size + 1), -1, np.int32)
        step = np.zeros((n, size + 1), np.int32)
        score = np.zeros((n, size + 1)) if v.kind == UNIGRAM else None
        for i in range(1, size + 1):
            j = np.arange(max(0, i - v.longest), i)
            key = mixed((total[:, i, None] - total[:, j]) * self.inverse[j] + (i - j).astype(_U))
            row, col = np.nonzero(v.maybe[(key >> _U(44)).astype(np.int64)])
            key = key[row, col]
            at = np.searchsorted(v.keys, key)
            at[at == len(v.keys)] = 0
            hit = v.keys[at] == key
            row, prev, t = row[hit], j[col[hit]], v.ids[at[hit]]
            if v.kind == BPE:
                ok = self._pairs(piece[row, prev], t)
                row, prev, t = row[ok], prev[ok], t[ok]
                value = prev.astype(float)  # one piece stands
            else:
                value = score[row, prev] + v.score[t]
            # rows come in order, each with a piece at least
            cut = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            best = np.maximum.reduceat(value, cut)
            win = np.flatnonzero(value == np.repeat(best, np.diff(np.r_[cut, len(row)])))
            win = win[np.r_[True, row[win][1:] != row[win][:-1]]]
            piece[row[win], i] = t[win]
            step[row[win], i] = i - prev[win]
            if score is not None:
                score[row[win], i] = best
        at, out, tokens = np.full(n, size), [], np.zeros(n, np.int64)
        live = np.arange(n)
        while len(live):
            out.append((live, piece[live, at[live]]))
            tokens[live] += 1
            at[live] -= step[live, at[live]]
            live = live[at[live] > 0]
        ids = np.zeros(int(tokens.sum()), np.int32)
        end = np.cumsum(tokens)
        for k, (rows, t) in enumerate(out):  # last tokens first
            ids[end[rows] - 1 - k] = t
        return ids, tokens

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each piece stands after the one before (-1: none)."""
        ok = np.ones(len(left), bool)
        some = np.flatnonzero(left >= 0)
        if not len(some):
            return ok
        key, back = np.unique(left[some].astype(np.int64) << 32 | right[some], return_inverse=True)
        if len(self.pair_key) > CACHED_PAIRS:
            self.pair_key, self.pair_ok = self.pair_key[:0], self.pair_ok[:0]
        at = np.searchsorted(self.pair_key, key)
        new = np.ones(len(key), bool)
        inside = at < len(self.pair_key)
        new[inside] = self.pair_key[at[inside]] != key[inside]
        found = np.zeros(len(key), bool)
        found[~new] = self.pair_ok[at[~new]]
        if new.any():
            steps, rank = self.v.steps, self.v.rank
            found[new] = [_stands(steps[k >> 32], steps[k & 0xFFFFFFFF], rank)
                          for k in key[new].tolist()]
            self.pair_key = np.insert(self.pair_key, at[new], key[new])
            self.pair_ok = np.insert(self.pair_ok, at[new], found[new])
        ok[some] = found[back]
        return ok

    # texts

    def decode(self, ids: np.ndarray, tokens: np.ndarray) -> list[str]:
        """The text of each run of ids; bytes that are not UTF-8 become
        U+FFFD, an id outside the vocabulary raises IndexError."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.v.size)):
            raise IndexError("an id outside the vocabulary")
        size = self.v.size[ids]
        raw = self.v.pool[ragged(self.v.start[ids], size)].tobytes()
        at = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(tokens)]].tolist()
        out = []
        for a, z in zip(at, at[1:]):
            t = raw[a:z].decode("utf-8", "replace")
            out.append(t[1:] if self.v.prefix and t[:1] == " " else t)
        return out


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           check: bool = False) -> DataFrame:
    """(`id_col`, token_ids array<int>, n_tokens) per row of `docs`, with
    `check` also (round_trip boolean): the decoded ids are the text.

    A null text has null ids, count and check; an empty one no ids. Very long
    texts and words are encoded whole. Repeated rows stay, null ids too; an empty
    table gives an empty one; other columns are not read. Text holding
    U+2581 itself decodes to spaces there, as in the library.
    """
    vocab = Vocabulary(model_path)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        codec = Codec(vocab)
        for b in slabs(batches, "text", SLAB_BYTES):
            texts = b.column("text").to_pylist()
            ids, n = codec.encode([t or "" for t in texts])
            null = np.array([t is None for t in texts], bool)
            offsets = pa.array(np.r_[0, np.cumsum(n)].astype(np.int32),
                               mask=np.r_[null, False] if null.any() else None)
            columns = [b.column("id"), pa.ListArray.from_arrays(offsets, pa.array(ids)),
                       pa.array(n.astype(np.int32), mask=null)]
            if check:
                same = np.array([a == t for a, t in zip(codec.decode(ids, n), texts)], bool)
                columns.append(pa.array(same, mask=null))
            yield pa.RecordBatch.from_arrays(columns, ["id", "token_ids", "n_tokens", "round_trip"][:len(columns)])

    schema = (f"id {rows.schema['id'].dataType.simpleString()}, token_ids array<int>, n_tokens int"
              + ", round_trip boolean" * check)
    out = ["token_ids", "n_tokens", "round_trip"][:2 + check]
    return map_texts(rows, run, schema).select(
        F.col("id").alias(id_col), *[F.col(c).alias(fresh(c, [id_col])) for c in out])


def decode(tokens: DataFrame, model_path: str, id_col: str = "doc_id",
           ids_col: str = "token_ids") -> DataFrame:
    """(`id_col`, text) per row of `tokens`: null for null ids, empty for
    none. A null among the ids counts as the unknown piece."""
    vocab = Vocabulary(model_path)
    rows = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches):
        codec = Codec(vocab)
        for b in batches:
            lists = b.column("ids")
            for lo in range(0, b.num_rows, 512):
                part = lists.slice(lo, 512)
                flat = part.flatten().fill_null(codec.v.unknown).to_numpy(zero_copy_only=False)
                n = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                text = pa.array(codec.decode(flat, n), pa.string(),
                                mask=part.is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([b.column("id").slice(lo, 512), text], ["id", "text"])

    return (map_texts(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, text string")
            .select(F.col("id").alias(id_col), F.col("text").alias(fresh("text", [id_col]))))
