"""Small documents with nulls, empty and long texts, ties, copies and clashing columns."""

import random

VOCAB = {
    "en": "the of and tion ing that with this reon thouse ander whole ster".split(),
    "de": "der die und nicht einkeit schaft über pfer ungen zwisch äußer mit auch".split(),
    "fr": "le la que dans être çais eaux ment pour elle été où ière".split(),
}
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, line int, bucket int, fp string, score double, rep long, label int"


def text(rng, lang, n):
    ws = [rng.choice(VOCAB[lang]) + rng.choice(("", "er", "s", rng.choice(VOCAB[lang]))) for _ in range(n)]
    out = []
    for i in range(0, len(ws), 11):
        out.append(" ".join(ws[i : i + 11]))
    return "\n".join(out)


def documents():
    rng = random.Random(11)
    docs = []
    for i in range(150):
        lang = rng.choice(sorted(VOCAB))
        docs.append([i, text(rng, lang, rng.choice([1, 2, 3, 8, 25, 60, 200])), lang])
    for i in range(150, 170):
        base = docs[rng.randrange(100)]
        words = base[1].split(" ")
        words[rng.randrange(len(words))] = "zzz"
        docs.append([i, rng.choice([base[1], base[1].upper(), " ".join(words)]), base[2]])
    passage = " ".join(rng.choices(VOCAB["en"], k=60))
    for i in range(170, 180):
        docs.append([i, f"{text(rng, 'en', 15)} {passage} {text(rng, 'en', 15)}", "en"])
    docs += [[200, None, "en"], [201, "", "en"], [202, " \n\t\n ", None], [203, "x" * 70_000, "en"], [204, "12 34 !!", "en"], [205, "the", None], [206, "a a a " * 4000, "en"], [207, "Élan été\x1cx\xa0y é ﬁn İΣΑΣ <|endoftext|> don't we'll", "fr"]]
    docs += [[None, docs[3][1], "en"], [None, None, None], [5, docs[5][1], docs[5][2]]]
    return [(i, t, g, f"s{(i or 0) % 3}" if i != 7 else None, None if t is None else len(t), 1, 2, "fp", 0.5, 9, 1) for i, t, g in docs]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, COLUMNS).repartition(3)
