"""Toxicity by compression distance.

Two zstandard dictionaries are trained: the ordinary one on windows of ordinary text; the toxic one on the passages of toxic text that
set it apart (runs of byte 8-grams that many toxic and few ordinary documents hold), with the ordinary one as its tail, so that
what both kinds of text share compresses alike.  Each window of a text is compressed once with either; a document's
statistic is the mean of the bytes that the toxic dictionary saves on a window.  Thresholds on it are calibrated: the score is the share of
toxic documents at that statistic, as a rising step curve (isotonic regression) of documents that the dictionaries of
their fold did not see.

Learnt from at most ``FIT_DOCS`` documents of each label, those of smallest hash of doc_id among those of up to ``FIT_BYTES``; the
share of toxic documents, which the calibration is weighted by, is counted over all labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, text_or_empty

FIT_DOCS = 1000
FIT_BYTES = 40_000
"""Longer documents are not learnt from (they are scored whole)."""
FIT_WINDOWS = 40_000
"""Windows of ordinary text, evenly from all documents learnt from, that its dictionary is trained on at most."""
THRESHOLD = 0.3
WINDOW_BYTES = 96
GRAM = 8
ORDINARY_DICT, TOXIC_DICT = 16384, 6144
LEAST_SHARE, LEAST_RATIO = 0.02, 20.0


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept for testing; a row without id is not one, and nothing is learnt from it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def windows(text: bytes, size: int = WINDOW_BYTES) -> list[bytes]:
    """The text cut at spaces into pieces of at most that many bytes (a longer word is cut anywhere)."""
    out, i, n = [], 0, len(text)
    while i < n:
        e = i + size
        if e < n:
            s = text.rfind(b" ", i + 1, e)
            if s > i:
                e = s + 1
        out.append(text[i:e])
        i = e
    return out


def prepared(text: str) -> bytes:
    return b" " + " ".join(text.lower().split()).encode("utf-8", "surrogatepass") + b" "


def _grams(text: bytes) -> np.ndarray:
    b = np.frombuffer(text, np.uint8).astype(np.uint64)
    n = max(len(b) - GRAM + 1, 0)
    code = np.zeros(n, np.uint64)
    for k in range(GRAM):
        code = (code << np.uint64(8)) | b[k : k + n]
    return code


def _document_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate([np.unique(_grams(t)) for t in texts]), return_counts=True)


def _passages(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Runs of byte 8-grams that set toxic documents apart."""
    keys, n = _document_counts(toxic)
    other, m = _document_counts(ordinary)
    at = np.minimum(np.searchsorted(other, keys), len(other) - 1)
    rest = np.where(other[at] == keys, m[at], 0)
    apart = keys[(n >= max(3, LEAST_SHARE * len(toxic))) & ((n + 0.5) / len(toxic) > LEAST_RATIO * (rest + 0.5) / len(ordinary))]
    out = []
    for t in toxic:
        hit = np.isin(_grams(t), apart)
        cover = np.zeros(len(t) + 1, np.int64)
        where = np.flatnonzero(hit)
        np.add.at(cover, where, 1)
        np.add.at(cover, where + GRAM, -1)
        inside = np.r_[0, (np.cumsum(cover)[:-1] > 0).astype(np.int8), 0]
        edge = np.flatnonzero(np.diff(inside))
        out += [t[lo:hi] for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
    return out


def _dictionary(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary's bytes; of samples too few to train on, the samples."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def train(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """(ordinary dictionary, toxic dictionary)."""
    every = [w for t in ordinary for w in windows(t)]
    base = _dictionary(ORDINARY_DICT, [every[k * len(every) // FIT_WINDOWS] for k in range(FIT_WINDOWS)] if len(every) > FIT_WINDOWS else every)
    runs = _passages(toxic, ordinary)
    extra = _dictionary(TOXIC_DICT, [b"".join(runs[i : i + 6]) for i in range(0, len(runs), 6)]) if runs else b""
    return base, extra + base


class Meter:
    """saved(text): the bytes that the toxic dictionary saves on a window of the text, in the mean."""

    def __init__(self, dictionaries: tuple[bytes, bytes]):
        self.ordinary, self.toxic = (self._compressor(d).compress for d in dictionaries)

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        own = zstandard.ZstdCompressionParameters(
            window_log=15, hash_log=14, chain_log=14, search_log=4, min_match=5, target_length=16, strategy=zstandard.STRATEGY_LAZY, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        if len(content) < 8:
            return zstandard.ZstdCompressor(compression_params=own)
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=own)
        return zstandard.ZstdCompressor(dict_data=d, compression_params=own)

    def saved(self, text: bytes) -> float:
        ordinary, toxic, pieces = self.ordinary, self.toxic, windows(text)
        return sum(len(ordinary(w)) - len(toxic(w)) for w in pieces) / max(len(pieces), 1)


def _rising(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (x, share) of the weighted share of y that never falls as x grows: neighbours that would are pooled, each pool with one part of ordinary text more."""
    levels, of = np.unique(x, return_inverse=True)
    pools: list[list[float]] = []  # least and greatest x, weight of y, weight
    for at, hit, w in zip(levels.tolist(), np.bincount(of, y * weight).tolist(), np.bincount(of, weight).tolist(), strict=True):
        pools.append([at, at, hit, w])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            _, most, h, n = pools.pop()
            pools[-1] = [pools[-1][0], most, pools[-1][2] + h, pools[-1][3] + n]
    one = weight.min()
    knots = np.array([k for p in pools for k in (p[:2] if p[0] < p[1] else p[:1])])
    shares = np.array([p[2] / (p[3] + one) for p in pools for _ in (p[:2] if p[0] < p[1] else p[:1])])
    return knots, np.maximum.accumulate(shares)


def fit(toxic: list[str], ordinary: list[str], share: float) -> tuple[tuple[bytes, bytes], tuple[np.ndarray, np.ndarray]]:
    """Dictionaries and calibration. share: of toxic among all labelled documents."""
    groups = [[prepared(t) for t in g] for g in (ordinary, toxic)]
    x, y = [], []
    for fold in (0, 1):
        rest = [g[1 - fold :: 2] or g for g in groups]
        meter = Meter(train(rest[1], rest[0]))
        for label, g in enumerate(groups):
            x += [meter.saved(t) for t in g[fold::2]]
            y += [label] * len(g[fold::2])
    y = np.array(y)
    n = np.bincount(y, minlength=2)
    weight = np.where(y == 1, share / n[1], (1 - share) / n[0]) * len(y)
    return train(groups[1], groups[0]), _rising(np.array(x), y, weight)


def learn(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS):
    """fit() on the labelled documents that are not held out; None if a label has none.

    Of a doc_id with several labels the highest counts, of one with several texts the least.  A hash below a bound that the counts
    give leaves little more than ``fit_docs`` ids of each label before they are put in order.
    """
    known = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    short = docs.where((F.octet_length("text") <= FIT_BYTES) & F.col("doc_id").isNotNull())
    usable = checkpoint(known.join(short.select("doc_id").distinct().withColumn("short", F.lit(True)), "doc_id", "left"))
    n = {k: 0 for k in (0, 1)} | {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n[0] or not n[1]:
        return None
    texts = []
    for label in (1, 0):
        own = usable.where((F.col("toxic") == label) & F.col("short"))
        share = min(1.0, (fit_docs + 8 * fit_docs**0.5 + 64) / max(own.count(), 1))
        chosen = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs).select("doc_id")
        rows = short.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).collect()
        texts.append([r["text"] for r in sorted(rows, key=lambda r: r["doc_id"])])
    return fit(*texts, n[1] / (n[0] + n[1])) if all(texts) else None


class Judge:
    """Scores of texts by a fitted model, or 0 without one."""

    def __init__(self, model):
        self.model, self.meter = model, Meter(model[0]) if model else None

    def scores(self, texts: pa.Array) -> np.ndarray:
        if not self.model or not len(texts):
            return np.zeros(len(texts))
        x = np.array([self.meter.saved(prepared(t.as_py() or "")) for t in texts])
        return np.interp(x, *self.model[1])


def score(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from a score of 0.3), for every row of docs.

    A null text is scored as an empty one, which has no windows; without documents of both labels to learn from all scores
    are 0.  Repeated rows are scored alike and stay; extra columns of either table are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, fit_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value)
        for batch in batches:
            p = judge.scores(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", held_out().alias("held_out"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """The documents not predicted toxic, in one pass and without a shuffle of texts; null texts are judged as empty ones."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, fit_docs))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value)
        for batch in batches:
            yield batch.filter(pa.array(judge.scores(batch.column(at)) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
