"""Colliding words, doc_ids with several texts, clashing columns, brute-force versions of the fitted operators, and the pipeline stage by stage."""

import hashlib
import itertools
import math
import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from fixtures import COLUMNS, documents, frame  # noqa: E402
from test_text_operators import brute_lines  # noqa: E402

from strandplan.llm import common, language, licenses, lines, packing, quality, simhash, substrings, tokens, toxicity  # noqa: E402
from strandplan.llm.queries import vocabulary_path  # noqa: E402

ROWS = documents()
PAIRS = "doc_id long, text string"


def thue_morse(n, a, b):
    return [b if k.bit_count() % 2 else a for k in range(n)]


UP, DOWN = thue_morse(1024, "ab", "ba"), thue_morse(1024, "ba", "ab")
WORD_UP, WORD_DOWN = "".join(thue_morse(1024, "a", "b")), "".join(thue_morse(1024, "b", "a"))


def test_hashes_tell_thue_morse_sequences_apart():
    for one, two in ((WORD_UP, WORD_DOWN), (WORD_UP[:200], WORD_DOWN[:200])):
        data = np.frombuffer(f"{one} {two} {one}".encode(), np.uint8)
        starts, ends, _ = common.word_bounds(data, np.array([0, len(data)]))
        for seed in (0, 1):
            h = common.word_hashes(data, starts, ends, seed)
            assert h[0] == h[2] != h[1]
        assert common.same_bytes(data, starts[[0, 0]], ends[[0, 0]], data, starts[1:], ends[1:]).tolist() == [False, True]
    words = np.concatenate([np.array([1, 2] if w == "ab" else [2, 1], np.uint64) for w in (*UP, *DOWN)])
    for k in (3, 8, 20, 2048):
        grams = common.gram_hashes(words, k)
        held = {}
        for i in range(0, len(words) - k + 1, 7):
            assert held.setdefault(grams[i], tuple(words[i : i + k].tolist())) == tuple(words[i : i + k].tolist())


def test_unlike_lines_of_a_thousand_words_stay(spark):
    """But for those that are near each other word by word."""
    df = spark.createDataFrame([(1, " ".join(UP)), (2, " ".join(DOWN)), (3, f"{WORD_UP} a b"), (4, f"{WORD_DOWN} a b"), (5, f"{WORD_UP} a b")], PAIRS)
    assert {r.doc_id for r in lines.repeated_lines(df).collect()} == {5} | ({2} if lines.within_bound(UP, DOWN) else set())


def test_unlike_windows_stay(spark):
    df = spark.createDataFrame([(1, f"{WORD_UP} " + " ".join(f"w{k}" for k in range(19))), (2, f"{WORD_DOWN} " + " ".join(f"w{k}" for k in range(19)))], PAIRS)
    assert [r.n_removed for r in substrings.remove_repeats(df).collect()] == [0, 0]
    df = spark.createDataFrame([(1, " ".join(UP)), (2, " ".join(DOWN))], PAIRS)
    got = {r.doc_id: r.n_removed for r in substrings.remove_repeats(df).collect()}
    assert got == brute_removed({1: " ".join(UP), 2: " ".join(DOWN)})


@pytest.mark.parametrize("weak", [False, True])
def test_counts_and_ids_of_colliding_words(weak, monkeypatch):
    """With a hash that has 16 values too: whatever is looked up is compared."""
    if weak:
        good = common.word_hashes
        for m in (quality, tokens):
            monkeypatch.setattr(m, "word_hashes", lambda *a: good(*a) & np.uint64(15))
    from tokenizers import Tokenizer

    enc, tok = tokens.ChunkEncoder(vocabulary_path()), Tokenizer.from_file(vocabulary_path())
    texts = [WORD_UP, WORD_DOWN, "some words more words", f"{WORD_DOWN} words {WORD_UP}", *(r[1] for r in ROWS[:20])]
    ids, rows = enc.encode(texts)
    for k, t in enumerate(texts):
        assert ids[rows[k] : rows[k + 1]].tolist() == tok.encode(t, add_special_tokens=False).ids
    assert quality.repeats_by_words(f"{WORD_UP}\n{WORD_DOWN}\n{WORD_UP}\n \n".encode()) == (1, 0)


def test_quality_counts_with_a_weak_hash(spark, tmp_path):
    """In workers, so the hash is weakened by a module of that name before the real one."""
    rows = [(1, f"{WORD_UP}\n{WORD_DOWN}"), (2, " ".join(UP) + "\n" + " ".join(DOWN)), (3, "a b c d e f g h\na b c d e f g h i")]
    got = {r.doc_id: r for r in quality.statistics(spark.createDataFrame([(*r, "en", "s") for r in rows], "doc_id long, text string, lang string, source string")).collect()}
    for i, t in rows:
        assert (got[i].n_dup_lines, got[i].n_repeat_words) == quality.repeats_by_words(t.encode())


def brute_removed(texts):
    seen, out = set(), {}
    for d in sorted(texts):
        w, gone = texts[d].split(), set()
        for k in range(len(w) - 19):
            key = tuple(w[k : k + 20])
            if key in seen:
                gone.update(range(k, k + 20))
            seen.add(key)
        out[d] = len(gone)
    return out


def test_branching_inside_repeats(spark):
    """Passages that overlap, begin and end in each other's middle, repeat with a period and stand at the ends of documents."""
    rng = random.Random(4)
    base = [f"b{k}" for k in range(300)]
    texts = {}
    for d in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            a = rng.randrange(280)
            parts += base[a : a + rng.randrange(10, 120)]
            parts += [f"x{rng.randrange(4)}" for _ in range(rng.randrange(3))]
        texts[d] = " ".join(parts)
    texts[60] = " ".join(["p", "q", "r"] * 60)
    texts[61] = " ".join(base[40:200])
    texts[62] = " ".join(["p", "q", "r"] * 20)
    df = spark.createDataFrame(list(texts.items()), PAIRS).repartition(5)
    assert {r.doc_id: r.n_removed for r in substrings.remove_repeats(df).collect()} == brute_removed(texts)
    spans = substrings.repeated_spans(df).where("source_doc_id is not null").collect()
    assert spans and max(r.n for r in spans) > 5
    for r in spans:
        w, s = texts[r.doc_id].split(), texts[r.source_doc_id].split()
        assert w[r.first : r.first + r.n + 19] == s[r.source_first : r.source_first + r.n + 19]


def test_compaction_by_links():
    ids, places = np.array([1, 1, 1, 1, 2]), np.array([3, 4, 5, 9, 10], np.int32)
    own, before = np.array([7, 8, 9, 10, 11], np.uint64), np.array([6, 7, 8, 9, 10], np.uint64)
    head, length = substrings.compacted(ids, places, own, before)
    assert head.tolist() == [True, False, False, True, True] and length.tolist() == [3, 0, 0, 1, 1]
    assert substrings.compacted(ids[:3], places[:3], np.array([1, 8, 9], np.uint64), before[:3])[1].tolist() == [1, 2, 0]


P, Q = " ".join(f"p{k}" for k in range(30)), " ".join(f"q{k}" for k in range(30))


def test_several_texts_of_one_doc_id_lose_nothing(spark):
    rows = [(1, P), (2, P), (2, Q), (2, Q)]
    df = spark.createDataFrame(rows, PAIRS).repartition(3)
    assert sorted((r.doc_id, r.n_removed, r.kept) for r in substrings.remove_repeats(df).collect()) == sorted([(1, 0, P), (2, 30, ""), (2, 0, Q), (2, 0, Q)])
    assert sorted((r.doc_id, r.text) for r in lines.dedup_lines(df).collect()) == sorted([(1, P), (2, ""), (2, Q), (2, Q)])
    assert sorted((r.doc_id, r.text) for r in simhash.keep_first(df).collect()) == [(1, P), (2, Q)]
    near = spark.createDataFrame([(1, P), (2, Q), (2, P.replace("p7", "z")), (2, "third text")], PAIRS)
    assert sorted(r.text for r in lines.dedup_lines(near).collect()) == sorted([P, Q, "", "third text"])
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)], "doc_id long, toxic int")
    many = spark.createDataFrame([(1, f"{t} {k}") for k, t in enumerate((P, Q) * 20)] + [(i, P) for i in range(2, 9)], PAIRS)
    assert toxicity.score(many, labels).count() == 47
    assert language.identify(many.selectExpr("*", "'en' as lang")).count() == 47


def test_clashing_columns(spark):
    rows = [(1, P, 7, "a", 5, None, 3, 4), (2, f"{P}\n{Q}", 8, "b", 6, None, 3, 4), (None, P, 9, "c", 7, None, 3, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _gone int, n_lines string, n_removed long, `_ROW` string, row int, line int")
    out = lines.dedup_lines(df)
    assert out.columns == df.columns and sorted((r.doc_id or 0, r.text, r._gone, r.n_lines, r.n_removed) for r in out.collect()) == [(0, P, 9, "c", 7), (1, P, 7, "a", 5), (2, Q, 8, "b", 6)]
    counted = lines.dedup_lines(df, counted=True)
    assert counted.columns.count("n_lines") == 1 and {(r.doc_id, r.n_lines, r.n_removed) for r in counted.collect()} == {(1, 1, 0), (2, 2, 1), (None, 1, 0)}
    assert simhash.keep_first(df).columns == df.columns and simhash.keep_first(df).count() == 3
    assert substrings.remove_repeats(df).count() == 3
    extra = df.selectExpr("*", "1 as license_id", "'x' as lang", "'y' as source", "2 as grp", "3 as score", "4 as piece", "5 as fp")
    assert licenses.find_licenses(extra).count() == 0 and quality.judge(extra).count() == 3 and packing.pack_documents(extra, vocabulary_path()).count() == 3


# ---------------------------------------------------------------- brute force


def test_licenses_against_every_window(spark):
    rng = random.Random(9)
    names, rows = sorted(licenses.NOTICES), []
    filler = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    for i in range(120):
        parts = [filler(rng.randrange(80))]
        for _ in range(rng.randrange(3)):
            w = licenses.NOTICES[rng.choice(names)].split()
            for _ in range(rng.randrange(1 + len(w) // 40)):
                w[rng.randrange(len(w))] = "changed"
            parts += [" ".join(w), filler(rng.randrange(10, 300))]
        rows.append((i, " ".join(parts)))
    rows += [(None, rows[3][1]), (3, rows[3][1]), (200, None), (201, ""), (202, "MIT")]
    df = spark.createDataFrame(rows, PAIRS).selectExpr("*", "1 as license_id", "2 as fullest")
    got = {(r.doc_id, r.license_id) for r in licenses.find_licenses(df).collect()}
    want = set()
    for i, t in rows:
        s = licenses.shingles_of(t or "").tolist()
        for name in names:
            template = set(licenses.shingles_of(licenses.NOTICES[name]).tolist())
            size = len(licenses.shingles_of(licenses.NOTICES[name]))
            if template & set(s) and any(len(template & set(s[k : k + size])) >= 0.8 * len(template) - 1e-9 for k in range(max(1, len(s) - size + 1))):
                want.add((i, name))
    assert len(want) > 80 and len(got & want) >= 0.99 * len(want)
    assert Counter((r.doc_id, r.license_id) for r in licenses.find_licenses(df).collect() if r.doc_id == 3) == Counter({k: 2 * v for k, v in Counter((3, n) for i, n in want if i == 3).items()})


def test_every_occurrence_of_a_licence(spark):
    mit = licenses.NOTICES["MIT"]
    text = f"{mit} {' '.join(f'w{k}' for k in range(100))} {mit} {mit}"
    got = sorted((r.word_start, r.word_end) for r in licenses.find_licenses(spark.createDataFrame([(1, text)], PAIRS)).collect() if r.license_id == "MIT")
    n = len(licenses.words_of(mit).split())
    assert got == [(0, n), (n + 100, 2 * n + 100), (2 * n + 100, 3 * n + 100)]
    two = {r.license_id: r.fullest for r in licenses.find_licenses(spark.createDataFrame([(1, licenses.NOTICES["GPL-3.0"])], PAIRS)).collect()}
    assert two == {"GPL-2.0": False, "GPL-3.0": True}


def test_least_determinant_of_all_subsets(spark):
    rng = np.random.default_rng(2)
    p, rows, best = len(quality.FEATURES), [], {}
    factor = quality.consistency(quality.KEPT_SHARE)
    for g in range(6):
        x = rng.normal(size=(16, p)) * rng.uniform(0.5, 2, p)
        x[13:] += rng.normal(size=p) * 12
        rows += [(f"g{g}", *r) for r in x.tolist()]
        best[f"g{g}"] = min(float(np.linalg.slogdet(quality._floored(np.cov(x[list(s)].T, bias=True) * factor))[1]) for s in itertools.combinations(range(16), 12))
    df = spark.createDataFrame(rows, "grp string, " + ", ".join(f"{f} double" for f in quality.FEATURES))
    got = {r.grp: r for r in quality.concentrated(df, 6).collect()}
    assert all(best[g] - 1e-6 <= got[g].log_det <= best[g] + 1.5 for g in best)
    assert sum(got[g].log_det <= best[g] + 0.05 for g in best) >= 2
    for g, *x in rows:
        d = np.array(x) - got[g].mean
        x = [r for r in rows if r[0] == g].index((g, *x))
        assert x < 13 or d @ np.array(got[g].inverse).reshape(p, p) @ d > 50


def test_consistency_factor():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200_000, 6))
    d = (x**2).sum(axis=1)
    near = x[d <= np.quantile(d, 0.75)]
    assert abs(1 / near.var() - quality.consistency(0.75)) < 0.01


def test_rising_shares_by_min_max():
    rng = np.random.default_rng(3)
    for _ in range(20):
        x, y = rng.integers(0, 12, 60) / 4, (rng.random(60) < 0.4).astype(int)
        w = np.where(y == 1, 0.5, 2.0)
        knots, shares = toxicity._rising(x, y, w)
        levels = np.unique(x)
        hit, n = (np.array([(v * (x == at)).sum() for at in levels]) for v in (y * w, w))
        iso = [max(min(hit[j : k + 1].sum() / n[j : k + 1].sum() for k in range(i, len(levels))) for j in range(i + 1)) for i in range(len(levels))]
        for at, v in zip(levels, iso):
            pool = [k for k in range(len(levels)) if abs(iso[k] - v) < 1e-12]
            assert math.isclose(np.interp(at, knots, shares), hit[pool].sum() / (n[pool].sum() + w.min()), abs_tol=1e-9)


def test_toxicity_statistic_and_score_by_hand(spark):
    rng = random.Random(5)
    plain = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) + rng.choice("xyz") for _ in range(80)) for _ in range(80)]
    toxic = [t + " vileword foulword nastyone" * 2 for t in plain[:40]]
    model = toxicity.fit(toxic, plain[40:], 0.5)
    judge = toxicity.Judge(model)
    for t in (*plain[:5], *toxic[:5], "", "x" * 1000):
        raw = toxicity.prepared(t)
        pieces, rest = [], raw
        while rest:
            cut = rest[: toxicity.WINDOW_BYTES]
            if len(rest) > toxicity.WINDOW_BYTES and (s := cut.rfind(b" ", 1)) > 0:
                cut = cut[: s + 1]
            pieces.append(cut)
            rest = rest[len(cut) :]
        one, two = (toxicity.Meter._compressor(d) for d in model[0])
        saved = sum(len(one.compress(w)) - len(two.compress(w)) for w in pieces) / max(1, len(pieces))
        assert math.isclose(judge.meter.saved(raw), saved)
        knots, shares = model[1]
        k = int(np.searchsorted(knots, saved))
        want = shares[0] if k == 0 else shares[-1] if k == len(knots) else shares[k - 1] + (shares[k] - shares[k - 1]) * (saved - knots[k - 1]) / (knots[k] - knots[k - 1])
        import pyarrow as pa

        assert math.isclose(float(judge.scores(pa.array([t]))[0]), float(want), abs_tol=1e-9)


def test_language_by_hand(spark):
    def slots(text):
        raw, out = b" " + " ".join(text.lower().split()).encode() + b" ", Counter()
        for n in (2, 3):
            for i in range(len(raw) - n + 1):
                code = n
                for b in raw[i : i + n]:
                    code = ((code ^ b) * 0x01000193) & 0xFFFFFFFF
                out[((code * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - language.BITS)] += 1
        return out

    rows = [(r[0], r[1], r[2]) for r in ROWS if r[0] is not None and r[1] and len(r[1]) < 3000][:90]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learn = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1 and r[2] is not None]
    df_of = Counter(k for r in learn for k in slots(r[1]))
    idf = {k: math.log((1 + len(learn)) / (1 + df_of[k])) + 1 for k in range(language.SIZE)}
    source = df.where(~language.held_out() & df.lang.isNotNull())
    model = language.centroids(source, language.inverse_frequencies(source))
    got = {r.doc_id: r for r in language.identify(df).collect()}
    for i, t, _ in rows:
        v = {k: math.log1p(n) * idf[k] for k, n in slots(t).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        cosine = [sum(x * float(c[k]) for k, x in v.items()) / norm for _, c, _ in model]
        if any(map(str.isalpha, t)):
            assert abs(got[i].score - min(1, max(cosine))) < 1e-4
            assert got[i].lang_pred in {m[0] for m, c in zip(model, cosine) if c > max(cosine) - 1e-5}


# ---------------------------------------------------------------- pipeline


def words_shingles(text, size=5):
    w = [x for x in re.split(r"[^\w]+|_", (text or "").lower()) if x]
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def test_pipeline_stage_by_stage(spark, tmp_path):
    import corpus_pipeline

    frame(spark).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(0, 150, 2)] + [(151, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    item = " ".join(ROWS[175][1].split()[12:40])
    spark.createDataFrame([(1, item), (2, None), (None, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    rows = [tuple(r) for r in docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / f"out{k}"))
        docs = spark.read.parquet(str(tmp_path / f"out{k}"))
        now = [tuple(r) for r in docs.collect()]
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "toxicity":
            judged = {(r.doc_id, r.predicted) for r in toxicity.score(spark.createDataFrame(rows, docs.schema), spark.read.parquet(str(tmp_path / "labels.parquet"))).collect()}
            assert Counter(now) == Counter(r for r in rows if (r[0], 0) in judged)
        elif name == "line_dedup":
            texts = {r[0]: r[1] or "" for r in rows if r[0] is not None}
            gone = brute_lines(texts)
            cut = lambda r: (r[1] or "") if r[0] is None else "\n".join(x for j, x in enumerate((r[1] or "").split("\n")) if (r[0], j) not in gone)
            assert Counter((r[0], r[1]) for r in now) == Counter((r[0], cut(r)) for r in rows)
            assert all(r[4] is None or r[4] == len(r[1]) for r in now)
        elif name == "simhash_near_dedup":
            fps = {r[0]: simhash.fingerprint_of(r[1]) for r in rows if r[0] is not None}
            group = {i: i for i in fps}
            moved = True
            while moved:
                moved = False
                for a, b in itertools.combinations(sorted(fps), 2):
                    low = min(group[a], group[b])
                    if (fps[a] ^ fps[b]).bit_count() <= 3 and max(group[a], group[b]) > low:
                        group[a] = group[b] = low
                        moved = True
            want = sorted({i for i in fps if group[i] == i})
            assert sorted(r[0] for r in now if r[0] is not None) == want
            assert sum(r[0] is None for r in now) == sum(r[0] is None for r in rows)
        elif name == "benchmark_decontamination":
            wanted = words_shingles(item)
            assert Counter(now) == Counter(r for r in rows if r[0] is None or len(wanted & words_shingles(r[1])) < math.ceil(0.8 * len(wanted) - 1e-9))
            assert len(now) < len(rows)
        else:
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(vocabulary_path())
            assert docs.groupBy("doc_id").sum("length").count() == len({r[0] for r in rows})
            assert sum(r[3] for r in now) == sum(len(tok.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows)
        rows = now
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()


def test_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline

    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
