"""Language identification by nearest centroid over normalised TF-IDF vectors of byte n-grams.

Document frequencies are counted over every row that may be learnt from.  Centroids, several for each language, are
clustered from at most ``FIT_DOCS`` of its documents, those of smallest hash of doc_id.  A document takes the language of the
nearest centroid by cosine; ``rejected`` says that it is further from it than the documents it was made of.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, text_or_empty

BITS = 13
SIZE = 1 << BITS
FIT_DOCS = 400
"""Documents of a language that its centroids are fitted on, at most."""
BROADCAST_IDS = 100_000
"""Ids of all samples that are sent to all executors, some two megabytes; of more languages the sample is joined by a shuffle."""
CLUSTERS = 4
ROUNDS = 12
REJECT_QUANTILE = 0.01
UNKNOWN = "und"
ROUND_BYTES = 1 << 20


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept for testing; a row without id is not one, and nothing is learnt from it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def counts(texts: list[str]) -> np.ndarray:
    """Rows of hashed 2- and 3-gram counts of the texts' lower-cased bytes, each text between two spaces."""
    blobs = [b" " + " ".join(t.lower().split()).encode("utf-8", "surrogatepass") + b" " for t in texts]
    data = np.frombuffer(b"".join(blobs), np.uint8).astype(np.uint32)
    sizes = np.fromiter(map(len, blobs), np.int64, len(blobs))
    row = np.repeat(np.arange(len(blobs), dtype=np.int64) * SIZE, sizes)
    total = np.zeros(len(blobs) * SIZE, np.int64)
    for n in (2, 3):
        code = np.full(max(len(data) - n + 1, 0), n, np.uint32)
        for k in range(n):
            code = (code ^ data[k : k + len(code)]) * np.uint32(0x01000193)
        code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        inside = row[: len(code)] == row[n - 1 : n - 1 + len(code)]
        total += np.bincount((row[: len(code)] + code)[inside], minlength=len(total))
    return total.reshape(len(blobs), SIZE)


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts(texts)).astype(np.float32) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _rounds(texts: list) -> Iterator[tuple[int, int]]:
    lo, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t) + SIZE // 8
        if held >= ROUND_BYTES:
            yield lo, i + 1
            lo, held = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def inverse_frequencies(learn: DataFrame) -> np.ndarray:
    """Of each n-gram slot over all rows: one vector of fixed size, summed by slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(SIZE, np.int64), 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            n += len(texts)
            for lo, hi in _rounds(texts):
                total += (counts(texts[lo:hi]) > 0).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, SIZE)), pa.array(np.r_[n, total])], ["slot", "n"])

    rows = learn.select(text_or_empty().alias("text")).mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(SIZE + 1)
    for r in rows:
        df[r["slot"] + 1] = r["n"]
    return (np.log((1 + df[0]) / (1 + df[1:])) + 1).astype(np.float32)


def cluster(v: np.ndarray, k: int = CLUSTERS, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means from a farthest-first start; deterministic."""
    mean = v.mean(axis=0)
    picks = [int(np.argmax(v @ mean))]
    while len(picks) < min(k, len(v)):
        near = (v @ v[picks].T).max(axis=1)
        picks.append(int(np.argmin(near)))
    c = v[picks].copy()
    for _ in range(rounds):
        own = np.argmax(v @ c.T, axis=1)
        for j in range(len(c)):
            if (own == j).any():
                m = v[own == j].mean(axis=0)
                c[j] = m / max(float(np.linalg.norm(m)), 1e-12)
    return c


def _sample(learn: DataFrame, fit_docs: int) -> DataFrame:
    """doc_id, lang, text of at most fit_docs documents of a language, those of smallest hash; of several texts of one the least.

    A hash below a bound that the language's count gives leaves little more than that before they are put in order.
    """
    ids = learn.select("doc_id", "lang").distinct()
    share = ids.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(fit_docs + 8 * fit_docs**0.5 + 64) / F.count("*")).alias("share"))
    nearest = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    few = ids.join(share, "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < (F.col("share") * (1 << 20)).cast("long") + 1)
    chosen = checkpoint(few.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= fit_docs).select("doc_id", "lang"))
    few_languages = chosen.count() <= BROADCAST_IDS
    return learn.select("doc_id", "lang", "text").join(F.broadcast(chosen) if few_languages else chosen, ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))


def centroids(learn: DataFrame, idf: np.ndarray, fit_docs: int = FIT_DOCS) -> list[tuple[str, np.ndarray, float]]:
    """(language, centroid, least cosine of its documents but for a few), in the order of languages.

    Texts become vectors of fixed size where they lie; those of a language's sample meet in one task.
    """

    def shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            rows = [x.tobytes() for lo, hi in _rounds(texts) for x in vectors(texts[lo:hi], idf)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], ["doc_id", "lang", "vector"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.stack([np.frombuffer(x, np.float32) for x in pdf.sort_values("doc_id")["vector"]])
        c = cluster(v)
        cosine = v @ c.T
        own = cosine.argmax(axis=1)
        least = [float(np.quantile(cosine[own == j, j], REJECT_QUANTILE)) if (own == j).any() else 1.0 for j in range(len(c))]
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "cluster": np.arange(len(c)), "centroid": [x.astype(float).tolist() for x in c], "least": least})

    shaped = _sample(learn, fit_docs).select("doc_id", "lang", "text").mapInArrow(shape, "doc_id long, lang string, vector binary")
    rows = shaped.groupBy("lang").applyInPandas(fit, "lang string, cluster int, centroid array<double>, least double").collect()
    return [(r["lang"], np.array(r["centroid"], np.float32), r["least"]) for r in sorted(rows, key=lambda r: (r["lang"], r["cluster"]))]


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the cosine, 0 to 1), rejected, for every row.

    A null text, or one without a letter, is ``und`` with score 0; so is every row if there is nothing to learn from.
    Ties go to the language that sorts first.  Repeated rows stay; an empty table gives an empty one.
    """
    learn = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    idf = inverse_frequencies(learn)
    model = centroids(learn, idf)
    names = np.array([m[0] for m in model], object)
    matrix = np.stack([m[1] for m in model], axis=1) if model else np.zeros((SIZE, 0), np.float32)
    least = np.array([m[2] for m in model])
    shared = docs.sparkSession.sparkContext.broadcast((idf, names, matrix, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, names, matrix, least = shared.value
        for batch in batches:
            texts = batch.column(2).to_pylist()
            lang, score, far = [], [], []
            for lo, hi in _rounds(texts):
                known = np.array([bool(len(names)) and any(map(str.isalpha, t)) for t in texts[lo:hi]], bool)
                cosine = np.clip(vectors(texts[lo:hi], idf) @ matrix, 0, 1) if len(names) else np.zeros((hi - lo, 1))
                best = cosine.argmax(axis=1)
                top = cosine[np.arange(hi - lo), best].astype(float)
                lang += [names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
                score += np.where(known, top, 0.0).tolist()
                far += (~known | (top < least[best] if len(names) else ~known)).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(far, pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = docs.select("doc_id", held_out().alias("held_out"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
