"""Quality rules: base counts of every text, and robust multivariate outliers by language and source.

Each text gives a vector of transformed statistics.  Within every language and source, and in the whole table, the minimum
covariance determinant is sought by concentration steps from three starts: centre and spread by medians, mean and covariance,
and the covariance of directions from the medians.  A step takes the distances of all rows and the mean and covariance of the ``KEPT_SHARE`` nearest;
steps go on until no determinant falls, and the start with the least one is taken.  Rows within the 97.5 % point of
chi-square then give the reweighted estimate, and every group's is drawn towards the whole table's as if ``PRIOR_ROWS`` rows of it had
been added, so that a group of few rows needs no rule of its own.

A step is one aggregate over all rows: counts and moments by group and bin of distance, combined within each task, of which
the nearest bins are added up (of the last one a fraction).  Nothing is sampled and no group is gathered.  Models are broadcast
up to ``BROADCAST_GROUPS`` groups and joined beyond that.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, gram_hashes, mix, same_bytes, text_chunks, text_or_empty, word_bounds, word_hashes

REPEAT_WINDOW = 8
LEAST_WORDS = 20
REPEAT_PERCENT = 30
KEPT_SHARE = 0.75
STEPS = 40
"""Steps after which it is an error that determinants still fall; some ten are usual."""
BINS_PER_DOUBLING = 16
MEDIAN_BINS = 256
"""Bins to one of a statistic's units, for medians and quartiles."""
PRIOR_ROWS = 100
BROADCAST_GROUPS = 20_000
FEATURES = ("word_length", "symbols", "capitals", "marks", "repeats", "dup_lines")
FLOORS = (0.05, 0.03, 0.06, 0.06, 0.08, 0.08)
"""The least standard deviation a statistic is taken to have; many are zero in nearly every text."""
INNER, REWEIGHT_SHARE = 14.449, 0.975
"""The 97.5 % point of chi-square with six degrees."""
CUTOFF = 50.0
"""Squared Mahalanobis distance beyond which a text is rejected: the point of chi-square with six degrees that one in two hundred
million passes, as the statistics have longer tails than a normal law (at the 99.99 % point, 27.9, 1.2 % of good texts fail)."""

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks", "n_capitals")


def _row_sums(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def repeats_by_words(text: bytes) -> tuple[int, int]:
    """n_dup_lines and n_repeat_words of one text, by the words themselves."""
    lines = [x for x in text.split(b"\n") if x.split()]
    words = text.split()
    n = Counter(tuple(words[k : k + REPEAT_WINDOW]) for k in range(len(words) - REPEAT_WINDOW + 1))
    covered = {p for k in range(len(words) - REPEAT_WINDOW + 1) if n[tuple(words[k : k + REPEAT_WINDOW])] > 1 for p in range(k, k + REPEAT_WINDOW)}
    return len(lines) - len(set(lines)), len(covered)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and COUNTS of every document; a null text has none of anything."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((len(COUNTS), batch.num_rows), np.int64)
            for lo, hi, data, offs in text_chunks(batch):
                starts, ends, first = word_bounds(data, offs)
                full = np.zeros(len(data) + 1, np.int64)
                full[starts] += 1
                full[ends] -= 1
                full = np.cumsum(full)[:-1] > 0
                rows = np.arange(hi - lo)
                out[0, lo:hi] = np.diff(first)
                out[1, lo:hi] = _row_sums(full & ((data & 0xC0) != 0x80), offs)
                out[2, lo:hi] = _row_sums(_SYMBOL[data], offs)
                out[6, lo:hi] = _row_sums(_MARK[data], offs)
                out[7, lo:hi] = _row_sums(_CAPITAL[data], offs)
                breaks = np.flatnonzero(data == 10)
                # a break that ends a row begins an empty line of it, not of the next row
                begin_of = np.r_[offs[:-1], breaks + 1]
                row_of = np.r_[rows, np.searchsorted(offs, breaks, "right") - 1]
                order = np.lexsort((begin_of, row_of))
                begin, row = begin_of[order], row_of[order]
                follow = np.r_[row[1:] == row[:-1], False]
                stop = np.where(follow, np.r_[begin[1:], 0] - 1, offs[row + 1])
                words = np.searchsorted(starts, stop) - np.searchsorted(starts, begin)
                has = words > 0
                begin, stop, row = begin[has], stop[has], row[has]
                out[5, lo:hi] = np.bincount(row, minlength=hi - lo)
                keys = mix(word_hashes(data, begin, stop) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                _, at, same = np.unique(keys, return_index=True, return_inverse=True)
                head = at[same]
                later = np.flatnonzero(head != np.arange(len(head)))
                out[3, lo:hi] = np.bincount(row[later], minlength=hi - lo)
                unlike = (row[later] != row[head[later]]) | ~same_bytes(data, begin[later], stop[later], data, begin[head[later]], stop[head[later]])
                by_words = set(row[later[unlike]].tolist())
                grams = gram_hashes(word_hashes(data, starts, ends), REPEAT_WINDOW)
                if len(grams):
                    row = np.searchsorted(first, np.arange(len(starts)), "right") - 1
                    at = np.flatnonzero(row[: len(grams)] == row[REPEAT_WINDOW - 1 :])
                    keys = mix(grams[at] + row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                    order = np.argsort(keys)
                    same = np.flatnonzero(keys[order][1:] == keys[order][:-1])
                    one, two = at[order[same]], at[order[same + 1]]
                    for k in range(REPEAT_WINDOW):
                        alike = (row[one] == row[two]) & same_bytes(data, starts[one + k], ends[one + k], data, starts[two + k], ends[two + k])
                        by_words |= set(row[one[~alike]].tolist()) | set(row[two[~alike]].tolist())
                    cover = np.zeros(len(starts) + 1, np.int64)
                    twice = np.unique(np.r_[one, two])
                    cover[twice] += 1
                    cover[twice + REPEAT_WINDOW] -= 1
                    out[4, lo:hi] = np.bincount(row[np.cumsum(cover)[:-1] > 0], minlength=hi - lo)
                for r in by_words:  # unlike pieces of one hash
                    out[3, lo + r], out[4, lo + r] = repeats_by_words(data[offs[r] : offs[r + 1]].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *map(pa.array, out)], ["doc_id", "lang", "source", *COUNTS])

    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    return docs.select("doc_id", "lang", "source", text_or_empty().alias("text")).mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def transformed() -> list[Column]:
    """The statistics as numbers of comparable spread: logarithm of a length, square roots of shares (a few words added, so that short texts don't stand out)."""
    chars, words, lines = F.col("word_chars") + 60, F.col("n_words") + 12, F.col("n_lines") + 3
    return [
        F.log((F.col("word_chars") + 60) / words),
        F.sqrt(F.col("n_symbols") / chars),
        F.sqrt(F.col("n_capitals") / chars),
        F.sqrt(F.col("n_marks") / chars),
        F.sqrt(F.col("n_repeat_words") / words),
        F.sqrt(F.col("n_dup_lines") / lines),
    ]


def _distance(mean: str = "mean", inverse: str = "inverse") -> Column:
    p = len(FEATURES)
    d = [F.col(f) - F.col(mean)[i] for i, f in enumerate(FEATURES)]
    total = F.lit(0.0)
    for i in range(p):
        row = F.lit(0.0)
        for j in range(p):
            row = row + F.col(inverse)[i * p + j] * d[j]
        total = total + d[i] * row
    return total


def consistency(share: float, p: int = len(FEATURES)) -> float:
    """What makes the covariance of a normal law's nearest share that of the law: share / P(chi2(p + 2) <= q), q the share's point of chi2(p); p even."""
    below = lambda q, m: 1 - math.exp(-q / 2) * sum((q / 2) ** k / math.factorial(k) for k in range(m))
    lo, hi = 0.0, 200.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid, p // 2) < share else (lo, mid)
    return share / below(lo, p // 2 + 1)


MODEL = "grp string, start int, n double, mean array<double>, cov array<double>, inverse array<double>, log_det double"


def _model_row(grp: str, start: int, n: float, mean: np.ndarray, cov: np.ndarray) -> dict:
    return {"grp": grp, "start": start, "n": n, "mean": mean.tolist(), "cov": cov.ravel().tolist(), "inverse": np.linalg.inv(cov).ravel().tolist(), "log_det": float(np.linalg.slogdet(cov)[1])}


def _floored(cov: np.ndarray) -> np.ndarray:
    return cov + np.diag(np.square(FLOORS))


def _sums(columns: list[Column]) -> list[Column]:
    p = len(columns)
    return [F.count("*").alias("n"), *(F.sum(c).alias(f"s{i}") for i, c in enumerate(columns)), *(F.sum(columns[i] * columns[j]).alias(f"c{i}_{j}") for i in range(p) for j in range(i, p))]


def _moments(pdf: pd.DataFrame, weight: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Weight, mean and covariance of weighted rows of _sums()."""
    p = len(FEATURES)
    add = lambda c: float((pdf[c].to_numpy(float) * weight).sum())
    n = max(add("n"), 1e-9)
    mean = np.array([add(f"s{i}") for i in range(p)]) / n
    cov = np.array([[add(f"c{min(i, j)}_{max(i, j)}") / n - mean[i] * mean[j] for j in range(p)] for i in range(p)])
    return n, mean, cov


def _beside(rows: DataFrame, model: DataFrame, groups: int) -> DataFrame:
    return rows.join(F.broadcast(model) if groups <= BROADCAST_GROUPS else model, "grp")


def _starts(rows: DataFrame, groups: int) -> DataFrame:
    p = len(FEATURES)
    bins = rows.select("grp", F.posexplode(F.array(*(F.floor(F.col(f) * MEDIAN_BINS) for f in FEATURES))).alias("f", "bin")).groupBy("grp", "f", "bin").agg(F.count("*").alias("n"))

    def medians(pdf: pd.DataFrame) -> pd.DataFrame:
        middle, spread = np.zeros(p), np.zeros(p)
        for f, own in pdf.groupby("f"):
            own = own.sort_values("bin")
            upto = own["n"].cumsum().to_numpy()
            low, middle[f], high = (own["bin"].to_numpy()[np.searchsorted(upto, q * upto[-1])] / MEDIAN_BINS + 0.5 / MEDIAN_BINS for q in (0.25, 0.5, 0.75))
            spread[f] = (high - low) / 1.349
        return pd.DataFrame([_model_row(pdf["grp"].iloc[0], 0, 0.0, middle, _floored(np.diag(spread**2)))])

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        n, mean, cov = _moments(pdf, np.ones(len(pdf)))
        return pd.DataFrame([_model_row(pdf["grp"].iloc[0], 1, n, mean, _floored(cov))])

    def directions(pdf: pd.DataFrame) -> pd.DataFrame:
        n, _, cov = _moments(pdf[[c for c in pdf if c[0] in "nsc"]], np.ones(len(pdf)))
        mean = np.array([pdf[f"m{i}"].iloc[0] for i in range(p)])
        second = cov + np.outer(*(np.array([pdf[f"s{i}"].iloc[0] / n for i in range(p)]),) * 2)
        return pd.DataFrame([_model_row(pdf["grp"].iloc[0], 2, n, mean, _floored(second * p))])

    middle = checkpoint(bins.groupBy("grp").applyInPandas(medians, MODEL))
    one = rows.groupBy("grp").agg(*_sums([F.col(f) for f in FEATURES]))
    far = _beside(rows, middle.select("grp", "mean", "inverse"), groups)
    out = far.select("grp", F.greatest(F.sqrt(_distance()), F.lit(1e-3)).alias("d"), "mean", *((F.col(f) - F.col("mean")[i]).alias(f"z{i}") for i, f in enumerate(FEATURES)))
    two = out.groupBy("grp").agg(*_sums([F.col(f"z{i}") / F.col("d") for i in range(p)]), *(F.first(F.col("mean")[i]).alias(f"m{i}") for i in range(p)))
    return checkpoint(middle.union(one.groupBy("grp").applyInPandas(whole, MODEL)).union(two.groupBy("grp").applyInPandas(directions, MODEL)))


def _step(rows: DataFrame, model: DataFrame, groups: int, share: float, factor: float) -> DataFrame:
    """The models of each group and start from the nearest share of its rows; a share of over 1: those within that distance."""
    far = _beside(rows, model.select("grp", "start", "mean", "inverse"), groups)
    near = F.floor(F.log2(_distance() + 1e-6) * BINS_PER_DOUBLING) if share <= 1 else F.when(_distance() <= share, 0).otherwise(1)
    binned = far.withColumn("bin", near.cast("int")).groupBy("grp", "start", "bin").agg(*_sums([F.col(f) for f in FEATURES]))

    def nearest(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        n = pdf["n"].to_numpy(float)
        if share <= 1:
            weight = np.clip((share * n.sum() - (np.cumsum(n) - n)) / n, 0, 1)
        else:
            weight = (pdf["bin"].to_numpy() == 0).astype(float)
        if not weight.any():
            weight = np.ones(len(n))
        _, mean, cov = _moments(pdf, weight)
        return pd.DataFrame([_model_row(pdf["grp"].iloc[0], int(pdf["start"].iloc[0]), n.sum(), mean, _floored(cov * factor))])

    return checkpoint(binned.groupBy("grp", "start").applyInPandas(nearest, MODEL))


def concentrated(rows: DataFrame, groups: int) -> DataFrame:
    """MODEL of the least determinant found for every group of rows (grp, FEATURES)."""
    factor = consistency(KEPT_SHARE)
    now = _step(rows, _starts(rows, groups), groups, KEPT_SHARE, factor)
    for _ in range(STEPS):
        after = _step(rows, now, groups, KEPT_SHARE, factor)
        fell = after.select("grp", "start", F.col("log_det").alias("after")).join(now.select("grp", "start", "log_det"), ["grp", "start"]).where("after < log_det - 1e-3").limit(1).count()
        now = after
        if not fell:
            break
    else:
        raise RuntimeError("determinants still fall")
    return checkpoint(now.groupBy("grp").agg(F.min_by(F.struct("start", "n", "mean", "cov", "inverse", "log_det"), F.struct("log_det", "start")).alias("m")).select("grp", "m.*"))


def estimates(rows: DataFrame) -> DataFrame:
    """MODEL of the reweighted estimate of every group of rows (grp, FEATURES)."""
    groups = rows.select("grp").distinct().count()
    return _step(rows, concentrated(rows, groups), groups, INNER, consistency(REWEIGHT_SHARE))


def _drawn(model: DataFrame) -> DataFrame:
    """grp, mean, inverse, each drawn towards the whole table's."""
    whole = model.where(F.col("grp") == WHOLE).select(F.col("mean").alias("w_mean"), F.col("cov").alias("w_cov")).first()
    if whole is None:
        return model.select("grp", "mean", "inverse")
    w_mean, w_cov = np.array(whole["w_mean"]), np.array(whole["w_cov"])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], []]
            for r in batch.to_pylist():
                own = r["n"] / (r["n"] + PRIOR_ROWS)
                cov = own * np.array(r["cov"]) + (1 - own) * w_cov
                for column, v in zip(out, (r["grp"], (own * np.array(r["mean"]) + (1 - own) * w_mean).tolist(), np.linalg.inv(cov.reshape(len(FEATURES), -1)).ravel().tolist()), strict=True):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.list_(pa.float64())), pa.array(out[2], pa.list_(pa.float64()))], ["grp", "mean", "inverse"])

    return model.select("grp", "n", "mean", "cov").mapInArrow(draw, "grp string, mean array<double>, inverse array<double>")


WHOLE = "\x1eall"


def judge(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, COUNTS, base_failed, distance, kept, one row for each of docs.

    Null languages and sources are groups of their own ("" for null); a null or wordless text fails the base rule.  The
    estimates are made of the rows that pass it; if none does, nothing is kept.  A group without such rows has the whole table's.  Repeated rows are judged alike and stay;
    an empty table gives an empty one; other columns are ignored.
    """
    group = F.concat_ws("\x1f", F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit("")))
    vector = [c.alias(f) for c, f in zip(transformed(), FEATURES, strict=True)]
    stats = checkpoint(statistics(docs).withColumn("base_failed", base_failed()).withColumn("grp", group).select("*", *vector))
    good = stats.where("not base_failed")
    model = checkpoint(_drawn(estimates(good.select(F.explode(F.array("grp", F.lit(WHOLE))).alias("grp"), *FEATURES))))
    scored = stats.join(F.broadcast(model) if model.count() <= BROADCAST_GROUPS else model, "grp", "left")
    distance = F.coalesce(_distance(), F.lit(float("inf")))
    return scored.select("doc_id", *COUNTS, "base_failed", distance.alias("distance"), (~F.col("base_failed") & (distance <= cutoff)).alias("kept"))
