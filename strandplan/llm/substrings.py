"""Repeated passages: 20-word windows that also start earlier, by compacting a de Bruijn graph of word k-mers.

A window of 20 words is an edge of the graph, from the node of its first 19 words to that of its last 19.

1. Edges that occur once cannot matter, and most do.  They are kept out by their minimiser, the 10-word k-mer of smallest hash in
   the window: equal windows have equal minimisers, so a window is repeated only if its minimiser is.  Each document's
   minimisers are counted; a repeated one sends back its source coordinates, and a join brings those to the texts.
2. All occurrences of an edge meet (dealt by the edge, so a k-mer that is common in many surroundings loads no one task).  They
   give its first source coordinate and two sums of hashes over all occurrences, of where each starts and of where the edge before
   it would start.
3. A node is nonbranching if one edge enters it, one leaves it, and no document starts or ends there: then both have the same
   occurrences, one word apart, which their sums tell.  Their first coordinates, too, are one word apart in one document, so a
   nonbranching path lies in one piece in its source document.  A shuffle by source document brings its edges together, and a
   merge of each edge's end with the start of the next compacts it, whatever its length.
4. An occurrence of a path's first edge stands for the whole path.  Those that are not the first are verified against the source
   coordinates of the path (edge by edge: the same 128 bits in both places) and become spans; a join by document removes them.

Counts, first coordinates and neighbours are combined within a task before anything moves (an entry that has lost within its task
goes on as a lost one), so a passage that a third of all documents hold reaches a reducer once for each task.  Edges are
compared by 128 bits of two independent hashes of their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PACKED, bucket_of, by_bucket, distinct_texts, from_planes, gram_hashes, ids_of, mix, pack, packed_batch, planes, shuffle_partitions, text_chunks, text_or_empty, unpack, with_row, word_bounds, word_hashes

WINDOW = 20
KMER = 10
FLUSH_ENTRIES = 500_000
ENTRY, PASSED, SEVERAL = 0, 1, 2


def minimisers(hashes: np.ndarray, first: np.ndarray, window: int, kmer: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window inside one row: its start, the place of its minimiser (the leftmost on ties), and that k-mer's hash."""
    grams = gram_hashes(hashes, kmer)
    width = window - kmer + 1
    m = len(hashes) - window + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low, at = grams[:m].copy(), np.zeros(m, np.int64)
    for j in range(1, width):
        other = grams[j : j + m]
        less = other < low
        np.copyto(low, other, where=less)
        at[less] = j
    inside = np.ones(m, bool)
    for j in (first[1:-1],):
        marks = np.zeros(len(hashes) + 1, np.int32)
        lo = np.clip(j - window + 1, 0, None)
        np.add.at(marks, lo, 1)
        np.add.at(marks, j, -1)
        inside &= np.cumsum(marks)[:m] == 0
    starts = np.flatnonzero(inside)
    return starts, starts + at[starts], low[starts]


def _first_of(keys: list[np.ndarray], *order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sort by keys, then order; and which of the sorted begin a group of equal keys."""
    by = np.lexsort((*reversed(order), *reversed(keys)))
    new = np.zeros(len(by), bool)
    if len(by):
        new[0] = True
        for k in keys:
            s = k[by]
            new[1:] |= s[1:] != s[:-1]
    return by, new


def _anchors(docs: DataFrame, buckets: int, window: int, kmer: int) -> DataFrame:
    """Packed: hash, row, place, and whether it is known to be repeated."""

    def flush(held: list[tuple]) -> pa.RecordBatch:
        keys, ids, places = (np.concatenate([h[i] for h in held]) for i in range(3))
        by, new = _first_of([keys], ids, places)
        group = np.cumsum(new) - 1
        many = np.bincount(group)[group] > 1 if len(by) else np.zeros(0, bool)
        head, rest = by[new], by[~new]
        rows = list(pack(bucket_of(keys[head], buckets), keys[head], ids[head], places[head], many[new].astype(np.uint8)))
        rows += pack(bucket_of(mix(ids[rest].view(np.uint64)), buckets), ids[rest], places[rest], kind=PASSED)
        return packed_batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            ids, ok = ids_of(batch, "row")
            for lo, hi, data, offs in text_chunks(batch):
                starts, ends, first = word_bounds(data, offs)
                _, at, keys = minimisers(word_hashes(data, starts, ends), first, window, kmer)
                if not len(at):
                    continue
                new = np.r_[True, at[1:] != at[:-1]]
                at, keys = at[new], keys[new]
                row = np.searchsorted(first, at, "right") - 1
                use = ok[lo:hi][row]
                at, keys, row = at[use], keys[use], row[use]
                held.append((keys, ids[lo:hi][row], (at - first[row]).astype(np.int32)))
                n += len(at)
                if n >= FLUSH_ENTRIES:
                    yield flush(held)
                    held, n = [], 0
        if held:
            yield flush(held)

    return docs.mapInArrow(run, PACKED)


def _repeated(anchors: DataFrame, partitions: int) -> DataFrame:
    """row, place of every repeated minimiser."""

    def reduce(payloads: list) -> Iterator[pa.RecordBatch]:
        entries, passed = [], []
        for p in payloads:
            if np.frombuffer(p, np.int64, 1)[0] == PASSED:
                passed.append(unpack(p, [np.int64, np.int32])[1])
            else:
                entries.append(unpack(p, [np.uint64, np.int64, np.int32, np.uint8])[1])
        if entries:
            keys, ids, places, many = (np.concatenate([e[i] for e in entries]) for i in range(4))
            by, new = _first_of([keys])
            group = np.cumsum(new) - 1
            hot = (np.bincount(group) > 1) | (np.bincount(group, weights=many[by]) > 0)
            keep = by[hot[group]]
            passed.append([ids[keep], places[keep]])
        for ids, places in passed:
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(places)], ["row", "place"])

    return by_bucket(anchors, reduce, "row long, place int", partitions)


def _where(ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    return mix(mix(ids.view(np.uint64)) + places.astype(np.int64).view(np.uint64))


def _kinds(kind: int, rows: list[tuple[int, bytes]]) -> list[tuple[int, bytes]]:
    return [(b, np.int64(kind).tobytes() + p) for b, p in rows]


def _edges(marked: DataFrame, buckets: int, window: int, kmer: int) -> DataFrame:
    """Packed: both hashes, row and place of each distinct window of a task around a repeated minimiser, with both sums if it has several there; lost within the task: row and place."""

    def flush(held: list[tuple]) -> pa.RecordBatch:
        one, two, ids, places = (np.concatenate([h[i] for h in held]) for i in range(4))
        by, new = _first_of([one, two], ids, places)
        begin = np.flatnonzero(new)
        single = np.diff(np.r_[begin, len(by)]) == 1
        kept = by[begin]
        own, before = (np.add.reduceat(_where(ids[by], places[by] - k), begin) for k in (0, 1))
        b = bucket_of(one[kept], buckets)
        few, some = kept[single], kept[~single]
        rows = _kinds(ENTRY, planes(b[single], one[few], two[few], ids[few], places[few]))
        rows += _kinds(SEVERAL, planes(b[~single], one[some], two[some], ids[some], places[some], own[~single], before[~single]))
        rest = by[~new]
        rest = rest[np.lexsort((places[rest], ids[rest]))]
        return packed_batch(rows + _kinds(PASSED, planes(bucket_of(mix(ids[rest].view(np.uint64)), buckets), ids[rest], places[rest])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            ids, _ = ids_of(batch, "row")
            lists = batch.column(2)
            ends_of = np.asarray(lists.offsets)
            places_of = np.asarray(lists.values).astype(np.int64)
            for lo, hi, data, offs in text_chunks(batch):
                starts, ends, first = word_bounds(data, offs)
                hashes = word_hashes(data, starts, ends)
                begin, at, _ = minimisers(hashes, first, window, kmer)
                marked_at = np.zeros(len(hashes) + 1, bool)
                size = np.diff(ends_of[lo : hi + 1])
                marked_at[np.minimum(np.repeat(first[:-1], size) + places_of[ends_of[lo] : ends_of[hi]], len(hashes))] = True
                begin = begin[marked_at[at]]
                if not len(begin):
                    continue
                row = np.searchsorted(first, begin, "right") - 1
                one = gram_hashes(hashes, window)[begin]
                two = gram_hashes(word_hashes(data, starts, ends, 1), window)[begin]
                held.append((one, two, ids[lo:hi][row], (begin - first[row]).astype(np.int32)))
                n += len(begin)
                if n >= FLUSH_ENTRIES:
                    yield flush(held)
                    held, n = [], 0
        if held:
            yield flush(held)

    return marked.select("row", "text", "places").mapInArrow(run, PACKED)


def _firsts(edges: DataFrame, buckets: int, partitions: int) -> DataFrame:
    """Packed, dealt by source: row and place of each repeated edge's first occurrence, its sums, and row and place of an occurrence (the first has the sums, others zeros); known lost: row and place."""

    def reduce(payloads: list) -> Iterator[pa.RecordBatch]:
        single, several = [], []
        for p in payloads:
            kind, body = np.frombuffer(p, np.int64, 1)[0], memoryview(p)[8:]
            if kind == PASSED:
                ids, places = from_planes([body], [np.int64, np.int32])
                yield packed_batch(_kinds(PASSED, planes(bucket_of(mix(ids.view(np.uint64)), buckets), ids, places)))
            else:
                (single if kind == ENTRY else several).append(body)
        parts = []
        if single:
            one, two, ids, places = from_planes(single, [np.uint64, np.uint64, np.int64, np.int32])
            parts.append((one, two, ids, places, _where(ids, places), _where(ids, places - 1), np.zeros(len(ids), bool)))
        if several:
            parts.append((*(cols := from_planes(several, [np.uint64, np.uint64, np.int64, np.int32, np.uint64, np.uint64])), np.ones(len(cols[0]), bool)))
        if not parts:
            return
        one, two, ids, places, own, before, more = (np.concatenate([p[i] for p in parts]) for i in range(7))
        by, new = _first_of([one, two], ids, places)
        begin = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        own, before = np.add.reduceat(own[by], begin), np.add.reduceat(before[by], begin)
        repeated = (np.diff(np.r_[begin, len(by)]) > 1) | np.logical_or.reduceat(more[by], begin)
        head, use = by[begin][group], repeated[group]
        by, head, group, new = by[use], head[use], group[use], new[use]
        order = np.lexsort((places[by], ids[by], places[head], ids[head]))
        by, head, group, new = by[order], head[order], group[order], new[order]
        b = bucket_of(mix(ids[head].view(np.uint64)), buckets)
        none = np.uint64(0)
        yield packed_batch(_kinds(ENTRY, planes(b, ids[head], places[head], np.where(new, own[group], none), np.where(new, before[group], none), ids[by], places[by])))

    return by_bucket(edges, reduce, PACKED, partitions)


def _runs(ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive windows of a document as one span: row, first, n."""
    by = np.lexsort((places, ids))
    ids, places = ids[by], places[by]
    new = np.r_[True, (ids[1:] != ids[:-1]) | (places[1:] > places[:-1] + 1)] if len(ids) else np.zeros(0, bool)
    cuts = np.r_[np.flatnonzero(new), len(ids)]
    last = places[cuts[1:] - 1] if len(ids) else places
    return ids[cuts[:-1]], places[cuts[:-1]], (last - places[cuts[:-1]] + 1).astype(np.int32)


def compacted(ids: np.ndarray, places: np.ndarray, own: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of edges in order of their first coordinates: which begin a nonbranching path, and the path's length there.

    Consecutive edges are linked if the occurrences of the former are those before the latter: the sums over them are equal.
    """
    linked = np.r_[False, (ids[1:] == ids[:-1]) & (places[1:] == places[:-1] + 1) & (own[:-1] == before[1:])] if len(ids) else np.zeros(0, bool)
    heads = np.flatnonzero(~linked)
    length = np.zeros(len(ids), np.int32)
    length[heads] = np.diff(np.r_[heads, len(ids)])
    return ~linked, length


def _lost(firsts: DataFrame, partitions: int) -> DataFrame:
    """row, first, n: spans of windows that start earlier elsewhere; with source_row, source_first for those that a path gives."""
    names = ["row", "first", "n", "source_row", "source_first"]

    def reduce(payloads: list) -> Iterator[pa.RecordBatch]:
        entries, passed = [], []
        for p in payloads:
            (passed if np.frombuffer(p, np.int64, 1)[0] == PASSED else entries).append(memoryview(p)[8:])
        if passed:
            ids, first, n = _runs(*from_planes(passed, [np.int64, np.int32]))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(first), pa.array(n), pa.nulls(len(ids), pa.int64()), pa.nulls(len(ids), pa.int32())], names)
        if entries:
            ids, places, own, before, at_id, at_place = from_planes(entries, [np.int64, np.int32, np.uint64, np.uint64, np.int64, np.int32])
            by, new = _first_of([ids, places], at_id, at_place)  # the first occurrence of an edge is its own first coordinate
            edge = by[new]
            head, length = compacted(ids[edge], places[edge], own[edge], before[edge])
            group = np.cumsum(new) - 1
            use = head[group] & ((at_id[by] != ids[by]) | (at_place[by] != places[by]))
            by, n = by[use], length[group[use]]
            yield pa.RecordBatch.from_arrays([pa.array(at_id[by]), pa.array(at_place[by]), pa.array(n), pa.array(ids[by]), pa.array(places[by])], names)

    return by_bucket(firsts, reduce, "row long, first int, n int, source_row long, source_first int", partitions)


def _spans(texts: DataFrame, window: int, kmer: int) -> DataFrame:
    """_lost() of texts (row, text)."""
    partitions = shuffle_partitions(texts.sparkSession)
    buckets = 2 * partitions  # three kinds of rows go to each from each task
    repeated = _repeated(_anchors(texts, buckets, window, kmer), partitions)
    places = repeated.groupBy("row").agg(F.collect_list("place").alias("places"))
    return _lost(_firsts(_edges(texts.join(places, "row").select("row", "text", "places"), buckets, window, kmer), buckets, partitions), partitions)


def repeated_spans(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """doc_id, first, n, source_doc_id, source_first: the windows first..first+n-1 (word numbers of their starts) of a document also start earlier.

    Earlier: in a document of smaller doc_id, or further left in the same.  Spans may touch.  The source is where a nonbranching
    path of the graph first occurs; it is null for a span whose earlier occurrence a task met itself.  Documents without doc_id have no place
    in that order and take no part; rows that repeat a doc_id and its text count as one document, different texts of one
    doc_id as several, in a fixed order.
    """
    shaped, repeated, _ = with_row(docs.select("doc_id", "text"), "row")
    named = shaped.where("row is not null").select("row", "doc_id").distinct()
    source = named.select(F.col("row").alias("source_row"), F.col("doc_id").alias("source_doc_id"))
    return _spans(distinct_texts(shaped, repeated), window, kmer).join(named, "row").join(source, "source_row", "left").select("doc_id", "first", "n", "source_doc_id", "source_first")


def remove_repeats(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by a space), one row for each of docs.

    Windows are judged as in repeated_spans.  A null text has no words; a document without doc_id loses none; texts shorter than a window
    lose none.  An empty table gives an empty one; other columns are ignored, whatever their names.
    """
    shaped, repeated, renumbered = with_row(docs.select("doc_id", text_or_empty().alias("text")), "row")
    texts = shaped.where("row is not null").select("row", "text", *(["doc_id"] if renumbered else []))  # one shuffle serves both joins if not
    spans = _spans(distinct_texts(shaped, repeated) if repeated else texts, window, kmer).groupBy("row").agg(F.collect_list(F.struct("first", "n")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                words = bytes(text.as_buffer()).split()
                n = len(words)
                if spans:
                    gone = np.zeros(n + 1, np.int32)
                    for s in spans:
                        gone[min(s["first"], n)] += 1
                        gone[min(s["first"] + s["n"] + window - 1, n)] -= 1
                    stay = np.cumsum(gone[:n]) == 0
                    words = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                n_words.append(n)
                n_removed.append(n - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    unnamed = shaped.where("row is null").select("doc_id", "text", F.lit(None).cast("array<struct<first:int,n:int>>").alias("spans"))
    return texts.join(spans, "row", "left").select(F.col("doc_id" if renumbered else "row").alias("doc_id"), "text", "spans").union(unnamed).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
