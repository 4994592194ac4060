"""Benchmark decontamination: size-partitioned MinHash containment search, in DataFrame functions only.

A test item is short and a document long, so their Jaccard similarity says little; what counts is the share of the
item's shingles that the document holds.  An item's sketch is its smallest k shingle hashes (a bottom-k MinHash).  Items
are partitioned by size, in powers of two, and each partition has the k that its largest item needs: with a share
of at least t, at most (1 - t) n of n shingles are missing, so of floor((1 - t) n) + 1 sketch values one at least is in
the document.  No contaminated document can be missed; exact shingle containment then verifies each candidate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, let, text_or_empty

SHINGLE = 5
CONTAINMENT = 0.8
BROADCAST_SHINGLES = 1_000_000
"""Items are sent to all executors up to so many shingles in all (8 MB); beyond that, both sides are shuffled."""


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def shingles_of(words: Column, size: int = SHINGLE) -> Column:
    """Distinct hashes of the runs of ``size`` words; of fewer words the whole; of none none."""

    def of(ws: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(ws) - size + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(ws, i, F.lit(size))))
        return F.when(F.size(ws) > 0, F.array_distinct(hashes)).otherwise(F.array().cast("array<bigint>"))

    return let(words, of)


def sketched(items: DataFrame, containment: float = CONTAINMENT, size: int = SHINGLE) -> DataFrame:
    """item_id, item_hashes, n_item, size_class, sketch."""
    words = items.where("item_id is not null").select("item_id", words_of(text_or_empty()).alias("words"))
    hashed = words.select("item_id", shingles_of(F.col("words"), size).alias("item_hashes")).withColumn("n_item", F.size("item_hashes")).where("n_item > 0")
    largest = F.pow(F.lit(2.0), F.col("size_class") + 1) - 1
    need = F.floor(largest * (1 - containment) + 1e-9).cast("int") + 1
    return hashed.withColumn("size_class", F.floor(F.log2("n_item")).cast("int")).withColumn("sketch", F.slice(F.array_sort("item_hashes"), F.lit(1), F.least(need, F.col("n_item"))))


def contaminated(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT, size: int = SHINGLE, broadcast_shingles: int = BROADCAST_SHINGLES) -> DataFrame:
    """doc_id, item_id, n_shared, n_item, containment of every document that holds at least that share of an item's shingles.

    Null and wordless texts hold nothing and are never held; rows without id take no part; a repeated row counts once;
    no items or no documents: no rows.  Other columns of either table are ignored.
    """
    held = checkpoint(sketched(items, containment, size))
    total = held.agg(F.coalesce(F.sum("n_item"), F.lit(0))).first()[0]
    sketch = held.select("item_id", F.explode("sketch").alias("h"))
    sets = held.select("item_id", "item_hashes", "n_item")
    words = docs.where("doc_id is not null").select("doc_id", words_of(text_or_empty()).alias("words"))
    hashed = words.select("doc_id", shingles_of(F.col("words"), size).alias("hashes"))
    if total <= broadcast_shingles:
        hits = hashed.select("doc_id", "hashes", F.explode("hashes").alias("h")).join(F.broadcast(sketch), "h").join(F.broadcast(sets), "item_id")
    else:
        pairs = hashed.select("doc_id", F.explode("hashes").alias("h")).join(sketch, "h").select("doc_id", "item_id").distinct()
        hits = pairs.join(hashed, "doc_id").join(sets, "item_id")
    shared = hits.select("doc_id", "item_id", F.size(F.array_intersect("hashes", "item_hashes")).alias("n_shared"), "n_item")
    return (
        shared.where(F.col("n_shared") >= F.ceil(F.col("n_item") * containment - 1e-9))
        .groupBy("doc_id", "item_id")
        .agg(F.max("n_shared").cast("long").alias("n_shared"), F.max("n_item").cast("long").alias("n_item"))
        .withColumn("containment", F.col("n_shared") / F.col("n_item"))
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item; rows without doc_id stay."""
    return docs.join(contaminated(docs, items).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
