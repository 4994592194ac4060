import random
import re

import pytest

from strandplan.llm import decontamination as dc


def shingles(text):
    ws = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    if not ws:
        return set()
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))}


def brute(docs, items):
    out = set()
    for d, t in docs:
        for i, u in items:
            if d is None or i is None or not (s := shingles(u)):
                continue
            n = len(s & shingles(t))
            if n >= 0.8 * len(s) - 1e-9:
                out.add((d, i, n, len(s)))
    return out


def world():
    rng = random.Random(5)
    vocab = [f"w{k}" for k in range(300)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 3, 6, 14, 30, 59, 70])))) for i in range(40)]
    items += [(100, None), (101, ""), (None, "a b c d e f"), (102, items[5][1]), (103, "Élan, vital; the END")]
    docs = []
    for d in range(120):
        words = rng.choices(vocab, k=rng.choice([0, 2, 40, 400]))
        if d % 2:
            it = (items[rng.randrange(40)][1] or "").split()
            if it and d % 4 == 1:
                it[rng.randrange(len(it))] = "changed"
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w.upper() + "," for w in it]
        docs.append((d, " ".join(words)))
    docs += [(500, None), (None, items[0][1]), (501, "see: élan vital - the end!"), (502, "w1 " * 3000), (3, docs[3][1])]
    return docs, items


@pytest.mark.parametrize("bound", [dc.BROADCAST_SHINGLES, 0])
def test_matches_brute_force(spark, bound):
    docs, items = world()
    d = spark.createDataFrame([(a, b, 1) for a, b in docs], "doc_id long, text string, n_item int")
    i = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in dc.contaminated(d, i, broadcast_shingles=bound).collect()}
    want = brute(docs, items)
    assert got == want and len(want) > 20
    kept = {r.doc_id for r in dc.without_contaminated(d, i).collect()}
    assert kept == {a for a, _ in docs} - {w[0] for w in want}


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    e = spark.createDataFrame([], "doc_id long, text string")
    i = spark.createDataFrame([], "item_id long, text string")
    assert dc.contaminated(d, i).collect() == [] and dc.contaminated(e, i).collect() == []
    assert dc.without_contaminated(d, i).count() == 1
