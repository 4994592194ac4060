"""Best-two-fit packing of token sequences.

Lengths are whole numbers from 1 to the capacity, so what has to be packed is known from a histogram of at most
``capacity`` counts, however many pieces there are.  The plan is made on that histogram: fill a bin greedily with the
longest pieces that fit, then replace its smallest piece with two unpacked ones that fit the expanded gap more
tightly, and use the arrangement as often as the counts allow.  The plan's slots are dealt to the pieces by their
rank within their length; ranks come from counts by (length, salt), so a length that a third of all pieces have
is dealt by many tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, shuffle_partitions, text_or_empty
from .tokens import encoder

CAPACITY = 2048
END_ID = 0
ROUND_CHARS = 1 << 19
PLAN_COLUMNS = "length long, rank_from long, rank_to long, copies long, first_sequence long, place long"


def pieces_of(docs: DataFrame, vocabulary: str | Callable[[], str], capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document; a null text counts as empty, which makes one piece of one id.

    vocabulary: the file's path, or what gives it on the worker that reads it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary() if callable(vocabulary) else vocabulary)

        def flush(ids: list, texts: list[str]) -> pa.RecordBatch:
            tokens, rows = enc.encode(texts)
            out: list[list] = [[], [], [], [], []]
            for k, doc in enumerate(ids):
                raw = np.append(tokens[rows[k] : rows[k + 1]], np.uint32(END_ID)).astype("<u4", copy=False)
                view = memoryview(raw).cast("B")
                for p, start in enumerate(range(0, len(raw), capacity)):
                    stop = min(start + capacity, len(raw))
                    for column, v in zip(out, (doc, p, start, stop - start, zlib.crc32(view[4 * start : 4 * stop])), strict=True):
                        column.append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

        for batch in batches:
            ids, texts, held = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc)
                texts.append(text.as_py())
                held += len(texts[-1])
                if held >= ROUND_CHARS:
                    yield flush(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield flush(ids, texts)

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Slots for that many pieces of each length: (length, first rank, rank after the last, copies in a bin, first bin, place of the first copy).

    The pieces ranked from..to-1 of a length go, ``copies`` at a time, to bins first, first+1, ...
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    used = np.zeros(capacity + 1, np.int64)
    slots: list[tuple[int, int, int, int, int, int]] = []
    bins = 0

    def longest(most: int, taken: dict[int, int]) -> int:
        """The longest length up to most of which a piece is left."""
        while most > 0:
            at = np.flatnonzero(left[1 : most + 1])
            if not len(at):
                return 0
            for k in at[::-1].tolist():
                if left[k + 1] > taken.get(k + 1, 0):
                    return k + 1
                if k + 1 in taken:
                    continue
            return 0
        return 0

    while left.any():
        taken: dict[int, int] = {}
        gap = capacity
        while gap and (k := longest(gap, taken)):
            n = min(gap // k, int(left[k]) - taken.get(k, 0))
            taken[k] = taken.get(k, 0) + n
            gap -= n * k
        if gap:
            small = min(taken)
            room = gap + small
            avail = left[: room + 1].copy()
            for k, n in taken.items():
                if k <= room:
                    avail[k] -= n
            have = np.flatnonzero(avail > 0)
            best = (small, 0, 0)
            if len(have):
                partner = np.searchsorted(have, room - have, "right") - 1
                for a, j in zip(have.tolist(), partner.tolist(), strict=True):
                    if j < 0:
                        continue
                    b = int(have[j])
                    if a == b and avail[a] < 2:
                        if j == 0:
                            continue
                        b = int(have[j - 1])
                    if a + b > best[0]:
                        best = (a + b, a, b)
            if best[0] > small:
                taken[small] -= 1
                if not taken[small]:
                    del taken[small]
                for k in best[1:]:
                    taken[k] = taken.get(k, 0) + 1
        times = min(int(left[k]) // n for k, n in taken.items())
        place = 0
        for k, n in sorted(taken.items(), reverse=True):
            slots.append((k, int(used[k]), int(used[k]) + times * n, n, bins, place))
            used[k] += times * n
            left[k] -= times * n
            place += n * k
        bins += times
    return slots


def best_two_fit(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The columns of pieces, with sequence_id and offset.

    pieces: doc_id, piece, length from 1 to capacity.  Each sequence is gapless from 0 and holds at most ``capacity``.
    An empty table gives an empty one; repeated rows are pieces of their own; ties are dealt in any order.
    Needs a materialised input (the ranks are made of it more than once).
    The plan goes to the driver as a histogram of at most ``capacity`` rows and back as a table of
    O(capacity) arrangements, each of at most sqrt(2 * capacity) lengths, whatever the input's size.
    """
    spark = pieces.sparkSession
    salts = 4 * shuffle_partitions(spark)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", *({"start", "ids_crc32"} & set(pieces.columns))), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if any(not 1 <= k <= capacity for k in histogram):
        raise ValueError("a piece is empty or longer than the capacity")
    slots = spark.createDataFrame(plan(histogram, capacity), PLAN_COLUMNS)
    before = counts.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    local = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    ranked = salted.withColumn("local", F.row_number().over(local) - 1).join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("local"))
    at = F.col("rank") - F.col("rank_from")
    return (
        ranked.join(F.broadcast(slots.withColumnRenamed("length", "slot_length")), (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")))
        .withColumn("sequence_id", F.col("first_sequence") + F.floor(at / F.col("copies")))
        .withColumn("offset", F.col("place") + F.pmod(at, F.col("copies")) * F.col("length"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def pack_documents(docs: DataFrame, vocabulary: str | Callable[[], str], capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return best_two_fit(checkpoint(pieces_of(docs, vocabulary, capacity)), capacity)
