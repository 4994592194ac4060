"""Shared pieces of the text operators: table access, Arrow batches, vectorised word hashing, packed shuffles.

Words are maximal runs of bytes outside ``\\x20`` and ``\\x09-\\x0D``; UTF-8 continuation bytes never fall in that
set, so the byte view and the code-point view give the same words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..graphs import checkpointed as checkpoint
from ..graphs import release  # noqa: F401
from ..session import ensure_importable

CHUNK_BYTES = 1 << 19
"""Text handled by one round of array work; one longer document makes a round of its own."""

PACKED = "bucket int, payload binary"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often the body names it (plans inline an expression at each use)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column of df has it (case aside, as Spark compares names)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_row(docs: DataFrame, row: str) -> tuple[DataFrame, bool, bool]:
    """docs with a column that tells apart the texts of one doc_id and orders as doc_id does, null without doc_id; whether two rows share a value; whether it is other than doc_id.

    It is the doc_id itself where no doc_id has two texts.  Otherwise the distinct (doc_id, XXH64 of the text) are put in order
    over ranges and numbered; of one doc_id's texts that of the lesser hash comes first.  Repeated rows share a number.
    """
    text_hash = F.xxhash64(text_or_empty())
    keys = docs.where("doc_id is not null").select("doc_id", text_hash.alias("h"))
    several = keys.groupBy("doc_id").agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("n"), F.coalesce(F.bool_or(F.col("lo") != F.col("hi")), F.lit(False)).alias("unlike")).first()
    if not several["unlike"]:
        return docs.withColumn(row, F.col("doc_id").cast("long")), several["n"] > 0, False
    ranged = keys.distinct().repartitionByRange(shuffle_partitions(docs.sparkSession), "doc_id", "h").sortWithinPartitions("doc_id", "h")
    numbered = checkpoint(ranged.withColumn(row, F.monotonically_increasing_id()))
    h = unused(docs, "h")
    doc, hashed = unused(left := docs.withColumn(h, text_hash), "_doc"), unused(left, "_h")
    numbered = numbered.select(F.col("doc_id").alias(doc), F.col("h").alias(hashed), row)
    return left.join(numbered, (F.col("doc_id") == F.col(doc)) & (F.col(h) == F.col(hashed)), "left").select(*docs.columns, row), True, True


def once_a_task(rows: DataFrame, *key: str) -> DataFrame:
    """Without the rows whose key a task has met already, so that the many copies of one don't meet in one reducer."""
    at = [rows.columns.index(k) for k in key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            new = []
            for k in zip(*(batch.column(i).to_pylist() for i in at), strict=True):
                new.append(k not in seen)
                seen.add(k)
            yield batch.filter(pa.array(new, pa.bool_()))

    return rows.mapInArrow(run, rows.schema)


def distinct_texts(shaped: DataFrame, repeated: bool, row: str = "row") -> DataFrame:
    """row, text of each row number once."""
    texts = shaped.where(F.col(row).isNotNull()).select(F.col(row).alias("row"), text_or_empty().alias("text"))
    return once_a_task(texts, "row").dropDuplicates(["row"]) if repeated else texts


# ---------------------------------------------------------------- Arrow batches


def text_chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, row offsets into the bytes); a null text counts as empty."""
    col = batch.column(batch.schema.get_field_index(column))
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    if pa.types.is_string(col.type):
        col = col.cast(pa.large_string())
    n = len(col)
    if not n:
        return
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, np.int64, n + 1 + col.offset)[col.offset :]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi, raw[offs[lo] : offs[hi]], (offs[lo : hi + 1] - offs[lo])
        lo = hi


def ids_of(batch: pa.RecordBatch, column: str = "doc_id") -> tuple[np.ndarray, np.ndarray]:
    """The ids as int64 and which of them are present."""
    col = batch.column(batch.schema.get_field_index(column))
    ok = np.asarray(col.is_valid())
    return np.asarray(pc.fill_null(col, 0).cast(pa.int64())), ok


# ---------------------------------------------------------------- word hashing

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits (public splitmix constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(data: np.ndarray, offs: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and for each row the index of its first word (one more at the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    full = ~space[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = full[:-1]
    cut = offs[1:-1]
    before[cut[cut < n]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = full[1:]
    after[cut[cut > 0] - 1] = False
    starts, ends = np.flatnonzero(full & ~before), np.flatnonzero(full & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


_ODD = np.uint64(0x9E3779B97F4A7C15)
_KEEP = np.array([0, *((1 << 8 * k) - 1 for k in range(1, 8)), (1 << 64) - 1], np.uint64)
"""Masks of the low 0 to 8 bytes of a lane."""
LONG_WORD = 256
"""Bytes above which a word is hashed and compared by itself instead of in lanes."""


def _lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, little-endian, zeros after the end."""
    return np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of pieces of bytes: eight bytes a round go through a bijective mixer, so pieces of one length up to eight
    bytes never collide; pieces of over ``LONG_WORD`` bytes by XXH64."""
    size = ends - starts
    lanes = _lanes(data)
    h = mix(mix(size.astype(np.uint64) + np.uint64(seed * 0x51ED2701 + 1)) + (lanes[starts] & _KEEP[np.minimum(size, 8)]))
    rest, at = np.flatnonzero((size > 8) & (size <= LONG_WORD)), 8
    while len(rest):
        h[rest] = mix(h[rest] * _ODD + (lanes[starts[rest] + at] & _KEEP[np.minimum(size[rest] - at, 8)]))
        at += 8
        rest = rest[size[rest] > at]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        h[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), seed)
    return h


def same_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray, o_starts: np.ndarray, o_ends: np.ndarray) -> np.ndarray:
    """Whether the pieces of data are those of other, byte by byte."""
    size = ends - starts
    same = size == o_ends - o_starts
    one = _lanes(data)
    two = one if other is data else _lanes(other)
    rest, at = np.flatnonzero(same & (size <= LONG_WORD)), 0
    while len(rest):
        keep = _KEEP[np.minimum(size[rest] - at, 8)]
        same[rest] = (one[starts[rest] + at] & keep) == (two[o_starts[rest] + at] & keep)
        at += 8
        rest = rest[(size[rest] > at) & same[rest]]
    for i in np.flatnonzero(same & (size > LONG_WORD)).tolist():
        same[i] = np.array_equal(data[starts[i] : ends[i]], other[o_starts[i] : o_ends[i]])
    return same


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Of each k consecutive words, whatever row they are in: a tree of mixed pairs."""
    m = len(hashes) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    level, span, out, done = hashes, 1, None, 0
    while True:
        if k & span:
            part = level[done : done + m]
            out = mix(part + np.uint64(k)) if out is None else mix(out * _ODD + part)
            done += span
        if 2 * span > k:
            return out
        level = mix(level[:-span] * _ODD + level[span:])
        span *= 2


# ---------------------------------------------------------------- packed shuffle


def pack(buckets: np.ndarray, *columns: np.ndarray, kind: int = 0) -> Iterator[tuple[int, bytes]]:
    """One row for each bucket: its entries, column by column, so that a shuffle moves few and compressible rows."""
    if not len(buckets):
        return
    order = np.argsort(buckets, kind="stable")
    b = buckets[order]
    cuts = np.flatnonzero(np.r_[True, b[1:] != b[:-1], True])
    cols = [c[order] for c in columns]
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield int(b[lo]), b"".join([np.array([kind, hi - lo], np.int64).tobytes(), *(c[lo:hi].tobytes() for c in cols)])


def unpack(payload: bytes, dtypes: list) -> tuple[int, list[np.ndarray]]:
    kind, n = np.frombuffer(payload, np.int64, 2).tolist()
    at, out = 16, []
    for t in dtypes:
        out.append(np.frombuffer(payload, t, n, at))
        at += n * np.dtype(t).itemsize
    return kind, out


def packed_batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "payload"])


def planes(buckets: np.ndarray, *columns: np.ndarray) -> list[tuple[int, bytes]]:
    """pack() with each column's bytes laid out by significance, compressed, as shuffles and checkpoints hold many of these."""
    order = np.argsort(buckets, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(buckets[order]) != 0, True]) if len(order) else np.zeros(1, int)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    rows = []
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        planes = b"".join(np.ascontiguousarray(c[order[lo:hi]]).view(np.uint8).reshape(hi - lo, -1).T.tobytes() for c in columns)
        rows.append((int(buckets[order[lo]]), np.int64(hi - lo).tobytes() + squeeze(planes)))
    return rows


def from_planes(payloads: list, dtypes: list) -> list[np.ndarray]:
    out, expand = [[] for _ in dtypes], zstandard.ZstdDecompressor().decompress
    for p in payloads:
        n, raw, at = int(np.frombuffer(p, np.int64, 1)[0]), expand(memoryview(p)[8:]), 0
        for k, t in enumerate(dtypes):
            size = np.dtype(t).itemsize
            out[k].append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(t).ravel())
            at += n * size
    return [np.concatenate(c) for c in out]


def by_bucket(df: DataFrame, reduce: Callable[[list[bytes]], Iterator[pa.RecordBatch]], schema: str, partitions: int) -> DataFrame:
    """Each bucket's payloads meet in one call of reduce; the memory it takes is that of one bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for b, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if b != now and held:
                    yield from reduce(held)
                    held = []
                now = b
                held.append(payload.as_buffer())
        if held:
            yield from reduce(held)

    return df.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)
