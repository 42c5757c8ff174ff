"""Compression-distance toxicity: two zstandard dictionaries, one of ordinary and one of toxic text.

A text is cut into short windows. Each distinct window is compressed once with either dictionary; the bytes that the toxic
dictionary saves are its evidence. Both dictionaries end in the same ordinary part, which zstandard's trainer picks from
ordinary passages; the toxic one goes on, farther back, with the parts of toxic passages that set the class apart: all
runs of byte n-grams that significantly more toxic than ordinary rows hold, whatever the language, stems of words as well
as phrases, with no list of words and no cut relative to the most frequent one. So a window costs the same under both
unless it shares such a part. (Two dictionaries that the trainer picks from whole passages of either class find a third of the
toxic rows at most, at a tenth of false positives: what sets the classes apart is a few words in a hundred.)

How many windows save how many bytes, out of how many, is weighed by a logistic calibration. It is fitted, like the
threshold, on labelled rows that the dictionary used for them has not seen: two dictionaries of half the rows each.
"""
from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, lean, small_batches, utf8

#: Bytes of a window; windows end at white space where there is some.
WINDOW = 40
#: Bytes of the ordinary part, and at most of the toxic one: the parts that the most rows hold come first.
BASE, OWN = 1500, 4096
#: Bytes of an n-gram, and how many standard errors the toxic rows' share of it must be above the ordinary rows'. Where no
#: n-gram is, as in small samples, the next lower demand counts.
GRAM, SURE = 7, (7.0, 5.0, 4.0)
#: Shares in which the n-grams of all rows are counted, one after the other: the driver holds one at a time.
PARTS = 4
#: The labelled rows used for fitting: so many of either class at most, none longer than so many characters.
FIT_ROWS, FIT_CHARS = 4000, 20_000
CUT_SCORE = 0.7
#: False positives that the threshold allows on rows unknown to the dictionary.
FALSE = 0.02
_LEVELS = (1, 2, 3, 4, 5, 6, 8, 10)
_STRONGEST = 6
_WINDOWS = re.compile(rb"[\s\S]{1,%d}(?=\s|\Z)|[\s\S]{1,%d}" % (WINDOW, WINDOW))
_PASSAGES = re.compile(rb"[\s\S]{1,200}(?=\s|\Z)|[\s\S]{1,200}")
#: What follows the entropy tables in a trained dictionary: the three first repeat offsets; content comes next.
_OFFSETS = b"\x01\0\0\0\x04\0\0\0\x08\0\0\0"


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows whose labels no fit may use: crc32 of the id's text leaves 1 when divided by 3; null ids are not held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _trained(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary's content; the samples themselves where there are too few to train on."""
    try:
        raw = zs.train_dictionary(size + 400, samples, k=64, d=8).as_bytes()
        at = raw.find(_OFFSETS)
        return raw[at + len(_OFFSETS):][-size:] if at >= 0 else raw[-size:]
    except zs.ZstdError:
        return b" ".join(dict.fromkeys(samples))[-size:]


def _grams(text: bytes) -> np.ndarray:
    """The n-gram that starts at each byte."""
    raw = np.frombuffer(text, np.uint8).astype(np.uint64)
    n = max(0, len(raw) - GRAM + 1)
    out = np.zeros(n, np.uint64)
    for i in range(GRAM):
        out = out << np.uint64(8) | raw[i:i + n]
    return out


def _rows_of(texts: list[bytes], part: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of one of PARTS shares, by remainder, and how many rows hold each."""
    grams = (_grams(x) for x in texts)
    return np.unique(np.concatenate([np.unique(g[g % np.uint64(PARTS) == part]) for g in grams]), return_counts=True)


def _apart(toxic: list[bytes], ordinary: list[bytes]) -> np.ndarray:
    """The n-grams, sorted, that significantly more toxic than ordinary rows hold."""
    found: dict[float, list[np.ndarray]] = {sure: [] for sure in SURE}
    for part in range(PARTS):  # the n-grams that are counted at once
        (gram, here), (other, there) = (_rows_of(texts, part) for texts in (toxic, ordinary))
        if len(other):
            at = np.minimum(np.searchsorted(other, gram), len(other) - 1)
            there = np.where(other[at] == gram, there[at], 0)
        else:
            there = np.zeros(len(gram), np.int64)
        a, b, both = here / len(toxic), there / len(ordinary), (here + there) / (len(toxic) + len(ordinary))
        error = np.sqrt(both * (1 - both) * (1 / len(toxic) + 1 / len(ordinary))) + 1e-9
        odds = np.log((here + 0.5) / (len(toxic) + 1)) - np.log((there + 0.5) / (len(ordinary) + 1))
        for sure in SURE:
            found[sure].append(gram[((a - b) / error > sure) & (odds > 1.5) & (here >= 3)])
    for sure in SURE:
        grams = np.sort(np.concatenate(found[sure]))
        if len(grams):
            break
    return grams


def _parts(text: bytes, grams: np.ndarray) -> list[bytes]:
    """The longest runs of a text that the n-grams cover."""
    mine = _grams(text)
    if not len(mine):
        return []
    starts = np.flatnonzero(grams[np.minimum(np.searchsorted(grams, mine), len(grams) - 1)] == mine)
    if not len(starts):
        return []
    first = np.concatenate([[True], np.diff(starts) > GRAM])
    last = np.concatenate([first[1:], [True]])
    return [text[i:j + GRAM] for i, j in zip(starts[first], starts[last], strict=True)]


def _own_text(rows: list[tuple[int, bytes]]) -> list[tuple[int, bytes]]:
    """The rows, lower case, without passages that other rows hold too: copies prove nothing about their class."""
    cut = [(y, list(dict.fromkeys(_WINDOWS.findall(x.lower())))) for y, x in rows]
    seen = Counter(w for _, ws in cut for w in ws)
    return [(y, b"\n".join(w for w in ws if seen[w] == 1 or 2 * len(w) < WINDOW)) for y, ws in cut]


def _calibrated(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights, the constant last, of a ridge logistic regression by Newton's method."""
    middle, width = x.mean(0), x.std(0) + 1e-6
    z = np.column_stack([(x - middle) / width, np.ones(len(x))])
    w, ridge = np.zeros(z.shape[1]), np.eye(z.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return np.append(w[:-1] / width, w[-1] - (w[:-1] * middle / width).sum())


class CompressionToxicity:
    """The fitted classifier; small, and shipped to executors as it is."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.toxic = ordinary, toxic
        self.tail, self.weights, self.cut = np.zeros(1), np.zeros(2 * len(_LEVELS) + 4), 0.0

    @staticmethod
    def _compressor(content: bytes) -> zs.ZstdCompressor:
        p = zs.ZstdCompressionParameters(window_log=15, strategy=zs.STRATEGY_LAZY, hash_log=14, chain_log=14, search_log=5, min_match=4, write_content_size=False)
        d = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=p)
        return zs.ZstdCompressor(compression_params=p, dict_data=d)

    @classmethod
    def of(cls, rows: list[tuple[int, bytes]]) -> CompressionToxicity:
        """Both dictionaries of labelled rows; no toxic one where nothing sets the classes apart."""
        toxic, ordinary = ([x for y, x in rows if y == side and x] for side in (1, 0))
        grams = _apart(toxic, ordinary) if toxic and ordinary else []
        own = b""
        for part, n in Counter(p for x in toxic for p in _parts(x, grams)).most_common() if len(grams) else ():
            if n >= 3 and part not in own and len(own) + len(part) < OWN:
                own = part + b"\n" + own
        shared = _trained([p for x in ordinary for p in _PASSAGES.findall(x)], BASE)
        return cls(shared, own + shared if own else b"")

    def savings(self):
        """A function from a text's bytes to its distinct windows' number and the bytes saved by those that save any."""
        o, t = self._compressor(self.ordinary).compress, self._compressor(self.toxic).compress

        def saved(text: bytes) -> tuple[int, list[int]]:
            windows = set(_WINDOWS.findall(text.lower()))
            return len(windows), [s for w in windows if (s := len(o(w)) - len(t(w))) > 0]

        return saved

    def _traits(self, windows: int, saved: list[int]) -> np.ndarray:
        counts = np.bincount(np.minimum(saved, _LEVELS[-1]), minlength=_LEVELS[-1] + 1) if saved else np.zeros(_LEVELS[-1] + 1)
        over = np.cumsum(counts[::-1])[::-1][list(_LEVELS)]
        n, last = math.log(windows + 1), len(self.tail) - 1
        top = sum(sorted((x for s in saved if (x := self.tail[min(s, last)] - n) > 0), reverse=True)[:_STRONGEST])
        return np.concatenate([np.log1p(over), np.sqrt(over / max(1, windows)), [n, top, math.sqrt(top), math.log1p(max(saved, default=0))]])

    def scorer(self):
        """A function from a text's bytes to its score, in (0, 1), CUT_SCORE or more from the cut on."""
        if not self.toxic:
            return lambda text: 0.0
        saved, at = self.savings(), math.log(CUT_SCORE / (1 - CUT_SCORE)) - self.cut
        return lambda text: 1 / (1 + math.exp(-max(-30.0, min(30.0, float(self._traits(*saved(text)) @ self.weights[:-1]) + self.weights[-1] + at))))

    @classmethod
    def fit(cls, rows: list[tuple[int, bytes]]) -> CompressionToxicity:
        """rows: label and text. A text that stands under both labels counts as toxic; the order of rows does not matter."""
        label: dict[bytes, int] = {}
        for y, x in rows:
            if x:
                label[x] = max(y, label.get(x, 0))
        texts = sorted(((y, x) for x, y in label.items()), key=lambda r: (zlib.crc32(r[1]), r[1]))
        own = _own_text(texts)
        model, seen, held = cls.of(own), Counter(), []
        if not model.toxic:
            return model
        for side in (0, 1):
            half = cls.of(own[side::2])
            saved = half.savings() if half.toxic else lambda text: (len(set(_WINDOWS.findall(text.lower()))), [])
            for y, x in texts[1 - side::2]:
                held.append((y, saved(x)))
                if not y:
                    seen.update(held[-1][1][1])
                    seen[0] += held[-1][1][0] - len(held[-1][1][1])
        total = sum(seen.values()) + 1
        model.tail = np.array([-math.log((sum(n for s, n in seen.items() if s >= x) + 0.5) / total) for x in range(25)])
        traits, labels = np.array([model._traits(*e) for _, e in held]), np.array([y for y, _ in held], float)
        model.weights = _calibrated(traits, labels)
        # The dictionary of all rows holds more than those of the halves: its own ordinary windows set the threshold. They
        # had no part in its toxic side but for the n-grams that they rule out.
        clean, saved = [], model.savings()
        for x in (x for y, x in texts if not y):
            clean.append(float(model._traits(*saved(x)) @ model.weights[:-1] + model.weights[-1]))
        clean.sort()
        model.cut = clean[min(len(clean) - 1, math.ceil(len(clean) * (1 - FALSE)))] + 1e-6
        return model


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, chars: int = FIT_CHARS) -> CompressionToxicity:
    """Fit on a bounded sample of labelled rows that are not held out: `rows` of either class at most, in hash order.

    The sample meets in one task, which fits: the driver gets the finished model only, as its memory is the least."""
    small_batches(docs.sparkSession)
    sides = []
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("_label"))
    for y in (0, 1):
        sides.append(known.where(F.col("_label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    sample = F.broadcast(sides[0].unionByName(sides[1]))  # 2 * rows ids at most
    got = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= chars)).join(sample, "doc_id")
    got = got.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * rows).select(F.col("_label").cast("int"), utf8("text").alias("_text")).coalesce(1)

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        if seen:
            yield pa.record_batch([pa.array([pickle.dumps(CompressionToxicity.fit(seen))], pa.binary())], names=["model"])

    made = got.mapInArrow(lean(fitted), "model binary").collect()
    return pickle.loads(made[0][0]) if made else CompressionToxicity.fit([])


def score(docs: DataFrame, model: CompressionToxicity, text: str = "text", names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """Add a score (double) and a prediction (int) to the rows; whole texts, null and empty ones included.

    A null or empty text has no window that saves a byte, and so about the least score. A very long text is cut into windows
    like any other; a task holds the distinct windows of one text at a time. Equal texts get equal scores, so repeated rows
    and ties do no harm. An empty table gives no rows. Other columns pass through; columns that have the names asked for
    are replaced. Without labelled rows, or where nothing sets the classes apart, every score is 0."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = model.scorer()
        try:
            for batch in texts:
                yield pa.array([one(x) for x in batch.to_pylist()], pa.float64())
        finally:
            give_back()

    out = docs.withColumn(names[0], scored(utf8(text)))
    return out.withColumn(names[1], (F.col(names[0]) >= CUT_SCORE).cast("int"))
