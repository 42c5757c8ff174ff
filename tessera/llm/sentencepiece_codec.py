"""SentencePiece encoding and decoding by batched numpy Viterbi.

Words of equal length advance together: at each start, the hashes of all substrings probe the sorted hashes of the
pieces, and vectorised maxima keep scores and backpointers. Each distinct word of a batch is encoded once.

Viterbi is the unigram model's search. For a model file of BPE type its pieces get the unigram scores -log(2 + rank);
the ids are then those of the library's unigram mode over the same pieces and scores, not of its BPE mode. Decoding does
not depend on that.
"""
from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, give_back, lean, small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Longer words are searched one by one. Bytes of the words and ids that a worker keeps during a task, to encode each once,
#: with what Python itself needs for each.
TOGETHER, KEPT, EACH = 48, 192 << 20, 220
UNKNOWN_PENALTY = 10.0
_UNITS = re.compile(r" *[^ ]+| +")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Vocabulary:
    """Pieces, scores and kinds of a model; a few hundred KB, and shipped to executors as it is."""

    def __init__(self, pieces: list[str], scores: np.ndarray, normal: np.ndarray, bytes_at: dict[int, int], unknown: int, prefix: bool = True):
        self.pieces, self.unknown, self.prefix = pieces, unknown, prefix
        self.scores = np.asarray(scores, np.float32)
        used = [i for i in np.flatnonzero(normal) if pieces[i]]
        if any(SPACE in pieces[i].lstrip(SPACE) for i in used):
            raise ValueError("a piece has a space inside: words cannot be encoded apart")
        self.longest = max(len(pieces[i]) for i in used)
        self.inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        self.power = np.full(TOGETHER + 2, _BASE, np.uint64)
        self.power[0] = 1
        self.power = np.multiply.accumulate(self.power)
        self.unpower = np.full(TOGETHER + 2, self.inverse, np.uint64)
        self.unpower[0] = 1
        self.unpower = np.multiply.accumulate(self.unpower)
        # Sorted keys: pieces, and beginnings of pieces (id -1), beyond which no longer substring needs a probe.
        known = {pieces[i]: i for i in used}
        for i in used:
            for k in range(1, len(pieces[i])):
                known.setdefault(pieces[i][:k], -1)
        hashes = np.array([self._hash(p) for p in known], np.uint64)
        order = np.argsort(hashes)
        self.keys, self.ids = hashes[order], np.array(list(known.values()), np.int32)[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        # Where the keys of each leading 18 bits begin, and the most keys that share them: a probe looks at so many.
        top = (self.keys >> np.uint64(46)).astype(np.int64)
        self.begins = np.searchsorted(top, np.arange((1 << 18) + 1)).astype(np.int32)
        self.most = int(np.diff(self.begins).max())
        self.keys = np.concatenate([self.keys, np.zeros(self.most, np.uint64)])
        self.ids = np.concatenate([self.ids, np.full(self.most, -2, np.int32)])
        self.least = np.float32(self.scores[used].min() - UNKNOWN_PENALTY)
        self.byte_id = np.full(256, unknown, np.int32)
        for i, b in bytes_at.items():
            self.byte_id[b] = i
        self.has_bytes = bool(bytes_at)
        self.output = [b"" if not normal[i] else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        for i, b in bytes_at.items():
            self.output[i] = bytes((b,))
        self.output[unknown] = " ⁇ ".encode()
        self.is_byte = np.zeros(len(pieces), bool)
        self.is_byte[list(bytes_at)] = True

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        """Read a model file on the driver."""
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        pieces = [m.id_to_piece(i) for i in range(n)]
        raw = np.array([m.get_score(i) for i in range(n)], np.float32)
        normal = np.array([not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i) or m.is_byte(i)) for i in range(n)])
        if (raw[normal] <= 0).all() and (raw[normal] == np.round(raw[normal])).all():  # ranks: a BPE model
            raw = np.where(normal, -np.log(2.0 - raw), 0).astype(np.float32)
        return cls(pieces, raw, normal, {i: int(pieces[i][3:5], 16) for i in range(n) if m.is_byte(i)}, m.unk_id(), m.encode("a", out_type=str)[0].startswith(SPACE))

    def _hash(self, word: str) -> int:
        code = np.array([ord(c) for c in word], np.uint64) + np.uint64(1)
        return int(_mix((code * self.power[: len(word)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(word)))[0]) if len(word) < len(self.power) else 0

    def _probe(self, q: np.ndarray) -> np.ndarray:
        """The piece of each substring hash; -1 where it only begins pieces, -2 where not even that."""
        at = self.begins[(q >> np.uint64(46)).astype(np.int64)]
        out = np.where(self.keys[at] == q, self.ids[at], -2)
        for j in range(1, self.most):
            more = np.flatnonzero(out == -2)
            if not len(more):
                break
            k = at[more] + j
            out[more] = np.where(self.keys[k] == q[more], self.ids[k], -2)
        return out

    def _unknown_bytes(self, text: str) -> list[int]:
        return [int(self.byte_id[b]) for b in text.encode("utf-8", "replace")] if self.has_bytes else [self.unknown]

    def viterbi(self, words: list[str]) -> list[bytes]:
        """The int32 ids, as bytes, of words of one length (at most TOGETHER code points)."""
        n, length = len(words), len(words[0])
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, length).T.astype(np.uint64) + np.uint64(1)
        sums = np.zeros((length + 1, n), np.uint64)
        np.cumsum(code * self.power[:length, None], axis=0, out=sums[1:])
        best = np.full((length + 1, n), -np.inf, np.float32)
        best[0] = 0
        back, piece = np.zeros((length + 1, n), np.int8), np.full((length + 1, n), -1, np.int32)
        for s in range(length):
            alive = None  # words in which the substring so far begins some piece
            for size in range(1, min(self.longest, length - s) + 1):
                e = s + size
                h = sums[e] - sums[s] if alive is None else sums[e, alive] - sums[s, alive]
                found = self._probe(_mix(h * self.unpower[s] + np.uint64(size)))
                if alive is None:
                    score = best[s] + np.where(found >= 0, self.scores[found], self.least)
                    better = score > best[e]
                    np.copyto(best[e], score, where=better)
                    np.copyto(back[e], np.int8(s), where=better)
                    np.copyto(piece[e], np.maximum(found, -1), where=better)
                    alive = np.flatnonzero(found > -2)
                else:
                    hit = found >= 0
                    who, got = alive[hit], found[hit]
                    score = best[s, who] + self.scores[got]
                    better = score > best[e, who]
                    who = who[better]
                    best[e, who], back[e, who], piece[e, who] = score[better], s, got[better]
                    alive = alive[found > -2]
                if not len(alive):
                    break
        # All words step back together; words with characters that no piece holds are written out one by one.
        at, row, steps, counts, strange = np.full(n, length), np.arange(n), [], np.zeros(n, np.int64), np.zeros(n, bool)
        while (on := at > 0).any():
            p = piece[at, row]
            strange |= on & (p < 0)
            counts += on
            steps.append(p)
            at = np.where(on, back[at, row], 0)
        raw = np.array(steps[::-1], np.int32).T.tobytes()  # a word's ids stand at the end of its row
        width = 4 * len(steps)
        out = [raw[(i + 1) * width - 4 * c: (i + 1) * width] for i, c in enumerate(counts.tolist())]
        for i in np.flatnonzero(strange).tolist():
            ids, e = [], length
            while e:
                p, s = int(piece[e, i]), int(back[e, i])
                ids.extend([p] if p >= 0 else self._unknown_bytes(words[i][s:e])[::-1])
                e = s
            out[i] = np.array(ids[::-1], np.int32).tobytes()
        return out

    def _long(self, word: str) -> bytes:
        """One long word: substrings of a slice of starts are probed together, the search goes on start by start."""
        n, width = len(word), self.longest
        code = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        best, back, piece = [-np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = np.float32(0)
        for at in range(0, n, 8192):
            part = code[at: at + 8192 + width]
            m = min(8192, n - at)
            hashes, hits = np.zeros(m, np.uint64), []
            for size in range(1, width + 1):
                k = min(m, len(part) - size + 1)
                if k <= 0:
                    break
                hashes[:k] += part[size - 1: size - 1 + k] * self.power[size - 1]
                got = np.full(m, -2, np.int32)
                got[:k] = self._probe(_mix(hashes[:k] + np.uint64(size)))
                hits.append(got)
            for i, row in enumerate(np.array(hits).T.tolist()):
                s = at + i
                for size, p in enumerate(row, 1):
                    if p < 0 and size > 1:
                        continue
                    score = best[s] + (self.scores[p] if p >= 0 else self.least)
                    if score > best[s + size]:
                        best[s + size], back[s + size], piece[s + size] = score, s, p
        ids, e = [], n
        while e:
            i, s = piece[e], back[e]
            ids.extend([i] if i >= 0 else self._unknown_bytes(word[s:e])[::-1])
            e = s
        return np.array(ids[::-1], np.int32).tobytes()

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words (spaces as SPACE)."""
        by_length, out = defaultdict(list), {}
        for w in words:
            by_length[len(w)].append(w)
        for length, same in by_length.items():
            if length > TOGETHER:
                out.update((w, self._long(w)) for w in same)
            else:
                step = max(1, (1 << 20) // (length + 1))
                for i in range(0, len(same), step):
                    out.update(zip(same[i: i + step], self.viterbi(same[i: i + step]), strict=True))
        return out

    def encoder(self):
        """A function from texts to the int32 ids of each, as bytes; it remembers the words it has seen, up to KEPT bytes."""
        known: dict[str, bytes] = {}
        held = 0

        def encode(texts: list[str]) -> list[bytes]:
            nonlocal held
            units = [_UNITS.findall(" " + t if self.prefix and t else t) for t in texts]
            if held > KEPT:
                known.clear()
                held = 0
            new = set().union(*units).difference(known)
            got = self.encode_words([w.replace(" ", SPACE) for w in new])
            for w in new:
                known[w] = ids = got[w.replace(" ", SPACE)]
                held += len(w) + len(ids) + EACH
            return [b"".join(map(known.__getitem__, u)) for u in units]

        return encode

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are not UTF-8 become replacement characters."""
        raw = b"".join(map(self.output.__getitem__, ids.tolist()))
        return (raw[1:] if self.prefix and raw.startswith(b" ") else raw).decode("utf-8", "replace")


def _columns(docs: DataFrame, text: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """The input's rows and columns plus `ids` (array of int) and `n_pieces`; clashing names get leading underscores.

    Null and empty texts have no ids. Characters without a piece become byte pieces. A literal U+2581 in a text decodes
    as a space, as in the library. Repeated rows get equal ids; a very long text is encoded whole, word by word, within one
    task; an empty table gives no rows."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = vocabulary.encoder()
        try:
            for batch in batches:
                got = run(["" if x is None else x for x in batch.to_pylist()])
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in got])]).astype(np.int32)
                yield pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(got), np.int32)))
        finally:
            run = None
            give_back()

    name, count = fresh(docs.columns, "ids"), fresh(docs.columns, "n_pieces")
    out = docs.withColumn(name, ids(F.col(text)))
    return out.withColumn(count, F.size(name).cast("long"))


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """The input plus `decoded`; null ids decode as empty."""
    small_batches(encoded.sparkSession)

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([vocabulary.decode(np.array(x if x is not None else [], np.int32)) for x in batch.to_pylist()], pa.string())

    return encoded.withColumn(fresh(encoded.columns, "decoded"), texts(F.col(ids)))


_DIGESTS = "doc_id long, n_pieces long, n_byte_pieces long, ids_sha256 string, decoded_sha256 string, round_trip boolean"


def digests(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """Per row: pieces, byte pieces, digests of the ids (little-endian int32) and of the decoded text, and whether the
    decoded text is the text (with U+2581 read as a space). Null texts count as empty; repeated rows, rows without id and
    very long texts give a row each like any other; an empty table gives none; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = vocabulary.encoder()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows = []
            for t, raw in zip(texts, encode_all(texts), strict=True):
                ids = np.frombuffer(raw, np.int32)
                back = vocabulary.decode(ids)
                rows.append((len(ids), int(vocabulary.is_byte[ids].sum()), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode("utf-8", "replace")).hexdigest(), back == t.replace(SPACE, " ")))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), t) for c, t in zip(cols, types, strict=True))], names=["doc_id", "n_pieces", "n_byte_pieces", "ids_sha256", "decoded_sha256", "round_trip"])

    return _columns(docs, text).mapInArrow(lean(run), _DIGESTS)
