"""SimHash near-duplicates: fingerprints of three-word shingles, linked at 3 or fewer differing bits.

Two fingerprints that differ in at most 3 of 64 bits share at least 5 of their 8 positional bytes.  The inverted index
holds, under each of 14 sets of four byte positions and the values there, the fingerprints that have them; the sets
are chosen so that any five positions contain one whole set, so no link is missed, and a list is 2**24 times shorter
than one of a single byte.  Within a list the shared positional bytes are tallied, pairs with the guaranteed five go on,
and their bits are counted.  Equal fingerprints are one entry, so copies never meet as pairs, and a list gives a spanning
forest of its links, not all pairs.

A list longer than ``LIST_LIMIT`` is split by the same index again: a link shares a fifth byte, so the list's entries go
to a list for each further position and the byte there.  If such a list is still too long, the 24 bits that are left are eight
positions of three bits, five of which a link shares, and the sets of four cut it into lists that hold at most 4096 fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..graphs import connected_components
from .common import PACKED, bucket_of, by_bucket, checkpoint, mix, once_a_task, pack, packed_batch, shuffle_partitions, text_or_empty, unpack, unused

SHINGLE = 3
MAX_BITS = 3
LEAST_BYTES = 8 - MAX_BITS
LIST_LIMIT = 20_000


def _position_sets() -> list[tuple[int, ...]]:
    """Fourteen sets of 4 of 8 positions, one of which is in any 5: both halves, and like-numbered pairings of each half."""
    pairings = [((0, 1), (2, 3)), ((0, 2), (1, 3)), ((0, 3), (1, 2))]
    return [(0, 1, 2, 3), (4, 5, 6, 7), *((*p, *(4 + x for x in q)) for ps in pairings for p in ps for q in ps)]


POSITION_SETS = _position_sets()


def fingerprint_of(text: str | None) -> int:
    """Of one text: the definition, which fingerprints() computes in batches."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[i : i + SHINGLE]), 42) for i in range(n)), np.uint64, n)
    return int(_votes(hashes))


def _votes(hashes: np.ndarray) -> np.uint64:
    bits = np.unpackbits(hashes.astype(">u8", copy=False).view(np.uint8).reshape(-1, 8), axis=1)
    total = np.zeros(64, np.int64)
    for lo in range(0, len(bits), 4096):
        total += bits[lo : lo + 4096].sum(axis=0, dtype=np.uint16)
    return np.packbits(total * 2 > len(hashes)).view(">u8")[0].astype(np.uint64)


def fingerprints(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns (doc_id if none are named), and fp (a long with the fingerprint's 64 bits) of every document."""
    columns = columns or ("doc_id",)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            for k, text in enumerate(batch.column(0)):
                raw = text.as_buffer() if text.is_valid else None
                words = bytes(raw).lower().split() if raw is not None else []
                if not words:
                    continue
                n = len(words)
                line = b" ".join(words)
                if n <= SHINGLE:
                    out[k] = _votes(np.array([digest(line, 42)], np.uint64))
                    continue
                ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
                starts = [0, *(ends[: n - SHINGLE] + 1).tolist()]
                stops = ends[SHINGLE - 1 :].tolist()
                out[k] = _votes(np.array([digest(line[s:e], 42) for s, e in zip(starts, stops, strict=True)], np.uint64))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(out.view(np.int64))], [*columns, "fp"])

    kinds = StructType([*(docs.schema[c] for c in columns), StructField("fp", LongType())])
    return docs.select(text_or_empty(), *columns).mapInArrow(run, kinds)


KINDS = [np.uint64, np.uint64, np.int64, np.uint8]


def _bytes(fps: np.ndarray) -> np.ndarray:
    return fps.astype(">u8").view(np.uint8).reshape(-1, 8)


def _first_lists(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Key and positions (as bits) of the 14 lists of each fingerprint, set by set."""
    parts = _bytes(fps).astype(np.uint64)
    keys = [(np.uint64(k) << np.uint64(32)) | (parts[:, a] << np.uint64(24)) | (parts[:, b] << np.uint64(16)) | (parts[:, c] << np.uint64(8)) | parts[:, d] for k, (a, b, c, d) in enumerate(POSITION_SETS)]
    return np.concatenate(keys), np.repeat(np.array([sum(1 << p for p in s) for s in POSITION_SETS], np.uint8), len(fps))


def _split_lists(keys: np.ndarray, fps: np.ndarray, used: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Entry, key and positions of the lists that the entries of over-long lists go to."""
    parts = _bytes(fps)
    four = np.bitwise_count(used) == 4
    for p in range(8):
        at = np.flatnonzero(four & ((used >> p) & 1 == 0))
        yield at, mix(mix(keys[at] + np.uint64(p + 1)) + parts[at, p]), used[at] | np.uint8(1 << p)
    at = np.flatnonzero(~four)
    free = np.argsort(np.unpackbits(used[at][:, None], axis=1, bitorder="little"), axis=1, kind="stable")[:, :3]
    rest = np.take_along_axis(parts[at], free, axis=1).astype(np.uint64)
    bits = (rest[:, 0] << np.uint64(16)) | (rest[:, 1] << np.uint64(8)) | rest[:, 2]
    for k, s in enumerate(POSITION_SETS):
        value = np.zeros(len(at), np.uint64)
        for p in s:
            value = (value << np.uint64(3)) | ((bits >> np.uint64(3 * p)) & np.uint64(7))
        yield at, mix(mix(keys[at] + np.uint64(100 + k)) + value), np.full(len(at), 255, np.uint8)


def _index(entries: DataFrame, buckets: int) -> DataFrame:
    """Packed lists: key, fingerprint, rep, positions that its members share.  entries: fp, rep, or fp, rep, key, used to split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, reps = np.asarray(batch.column(0)).view(np.uint64), np.asarray(batch.column(1))
            if batch.num_columns == 2:
                keys, used = _first_lists(fps)
                at = np.tile(np.arange(len(fps)), len(POSITION_SETS))
            else:
                at, keys, used = map(np.concatenate, zip(*_split_lists(np.asarray(batch.column(2)).view(np.uint64), fps, np.asarray(batch.column(3)).astype(np.uint8)), strict=True))
            yield packed_batch(list(pack(bucket_of(mix(keys), buckets), keys, fps[at], reps[at], used)))

    return entries.mapInArrow(run, PACKED)


def spanning_links(fps: np.ndarray) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints, as positions: each is compared with those not reached yet."""
    parts = fps.astype(">u8").view(np.uint8).reshape(-1, 8)
    left = np.arange(len(fps))
    while len(left):
        front = [left[0]]
        left = left[1:]
        while front and len(left):
            x = front.pop()
            shared = (parts[left] == parts[x]).sum(axis=1)
            near = shared >= LEAST_BYTES
            near[near] = np.bitwise_count(fps[left[near]] ^ fps[x]) <= MAX_BITS
            found = left[near]
            for y in found.tolist():
                yield int(x), y
            front.extend(found.tolist())
            left = left[~near]


def _links(index: DataFrame, partitions: int, limit: int) -> DataFrame:
    """a, b (reps of linked fingerprints); of lists over the limit instead fp, rep, key, used of each entry."""
    names = ["a", "b", "fp", "rep", "key", "used"]

    def reduce(payloads: list) -> Iterator[pa.RecordBatch]:
        cols = [unpack(p, KINDS)[1] for p in payloads]
        keys, fps, reps, used = (np.concatenate([c[i] for c in cols]) for i in range(4))
        order = np.argsort(keys, kind="stable")
        keys, fps, reps, used = keys[order], fps[order], reps[order], used[order]
        cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
        size = np.diff(cuts)
        a, b = [], []
        for g in np.flatnonzero(size > 1).tolist():
            lo, hi = cuts[g], cuts[g + 1]
            if hi - lo > limit and used[lo] != 255:
                none = pa.nulls(hi - lo, pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, pa.array(fps[lo:hi].view(np.int64)), pa.array(reps[lo:hi]), pa.array(keys[lo:hi].view(np.int64)), pa.array(used[lo:hi].astype(np.int32))], names)
                continue
            for i, j in spanning_links(fps[lo:hi]):
                a.append(reps[lo + i])
                b.append(reps[lo + j])
        n = len(a)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), *(pa.nulls(n, pa.int64()) for _ in range(3)), pa.nulls(n, pa.int32())], names)

    return by_bucket(index, reduce, "a long, b long, fp long, rep long, key long, used int", partitions)


def _components(entries: DataFrame, limit: int) -> DataFrame:
    """fp, component_id of entries (fp, rep)."""
    partitions = shuffle_partitions(entries.sparkSession)
    edges, todo = None, entries.where("rep is not null").select("fp", "rep")
    while True:  # three rounds at most: lists of four bytes, of five, and of five and twelve bits
        links = checkpoint(_links(_index(todo, 2 * partitions), partitions, limit))
        found = links.where("a is not null").select("a", "b")
        edges = found if edges is None else edges.union(found)
        todo = links.where("a is null").select("fp", "rep", "key", "used").distinct()
        if not todo.limit(1).count():
            break
    of = connected_components(edges)
    return entries.join(of, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("component", "rep").alias("component_id"))


def near_duplicates(docs: DataFrame, limit: int = LIST_LIMIT) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id (smallest doc_id reachable over links).

    A null or wordless text has fingerprint zero and links like any other; a text of fewer than three words has one
    shingle, the whole.  A null doc_id takes part with its fingerprint but names no component: it gets the smallest
    doc_id of its component, or null if there is none.  Repeated rows stay repeated.  An empty table gives an empty one.
    """
    fps = checkpoint(fingerprints(docs))
    entries = checkpoint(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    return fps.join(_components(entries, limit), "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, limit: int = LIST_LIMIT) -> DataFrame:
    """One document of each component: that of the smallest doc_id, and of several texts or rows of it the one of least hash.

    Rows alike in every column are one document.  Rows without doc_id stay.  An empty table gives an empty one; other columns
    pass through, whatever their names (maps and variants are left out of the hash).
    """
    row = unused(docs, "_row")
    marked = docs.withColumn(row, F.xxhash64(*(c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind)))
    fps = checkpoint(fingerprints(marked.where("doc_id is not null"), "doc_id", row))
    least = fps.groupBy("fp").agg(F.min(F.struct("doc_id", row)).alias("least"))
    entries = checkpoint(least.select("fp", F.col("least.doc_id").alias("rep"), "least"))
    kept = entries.join(_components(entries.select("fp", "rep"), limit), "fp").groupBy("component_id").agg(F.min("least").alias("least")).select("least.*")
    named = marked.where("doc_id is not null")
    repeated = bool(fps.groupBy("doc_id", row).count().where("count > 1").limit(1).count())
    if repeated:
        named = once_a_task(named, "doc_id", row)
    named = named.join(kept, ["doc_id", row], "left_semi")
    if repeated:
        named = named.dropDuplicates(["doc_id", row])
    return named.select(*docs.columns).union(docs.where("doc_id is null"))
