"""Secret scans, in DataFrame functions only.

Three base kinds are found by pattern; a fourth, ``entropy``, by sliding a window over candidate strings and taking the
Shannon entropy of the window's characters within the candidate's class.  The counts of the window are kept up to
date as a character enters and one leaves, so a step costs the alphabet's size whatever the window's.  Candidates that
an allow-list names (identifiers, placeholders, alphabets, plain numbers) are passed over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, text_or_empty

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINT = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
WINDOW = 20
HEX_ALPHABET = "0123456789abcdef"
BASE64_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
HEX_BITS, BASE64_BITS = 3.0, 3.9
"""Of the entropy of 20 characters drawn from an alphabet of 16 or 64, in bits; prose and paths stay below."""

CLASSES = (
    (r"^(?=.*[0-9])[a-z0-9]+=*$", 3.4),
    (r"^[A-Z2-7]+=*$", 3.34),
    (r"^(?=.*[0-9])[A-Z0-9]+=*$", 3.4),
    (r"^[a-z]+$", 3.35),
    (r"^[A-Za-z]+$", 3.58),
    (r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z]).*$", 3.65),
)
"""Class, by pattern, and the bits that 99 % (lower-case letters, which long words come near: 95 %) of random strings of 20 reach."""

ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[0-9+/_=-]+$",
    r"(?i)example|placeholder|changeme|dummy|sample|xxxx|test[_-]?key",
    r"(?i)abcdefghij|0123456789|qwertyuiop",
)
KINDS = ("assign", "access", "hex", "entropy")
BLOCK = 256


def _running(parts: Column) -> Column:
    """start, end and keep of each match from (gap, size, keep) of all; in blocks, as a growing array is copied at each step."""
    long0 = F.lit(0).cast("long")
    span = "array<struct<start:bigint,end:bigint,keep:boolean,value:string>>"

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["size"]
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(F.struct(start.alias("start"), end.alias("end"), x["keep"].alias("keep"), x["value"].alias("value")))).alias("spans"))

    def in_block(block: Column) -> Column:
        return F.aggregate(block, F.struct(long0.alias("at"), F.array().cast(span).alias("spans")), step)

    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int"))), lambda b: in_block(F.slice(parts, b * BLOCK + 1, F.lit(BLOCK))))

    def push(acc: Column, b: Column) -> Column:
        return F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts"))

    def joined(blocks: Column) -> Column:
        starts = F.aggregate(blocks, F.struct(long0.alias("at"), F.array().cast("array<bigint>").alias("starts")), push)["starts"]
        shifted = F.zip_with(blocks, starts, lambda b, at: F.transform(b["spans"], lambda s: F.struct((s["start"] + at).alias("start"), (s["end"] + at).alias("end"), s["keep"].alias("keep"), s["value"].alias("value"))))
        return F.flatten(shifted)

    return let(blocks, joined)


def _matches(text: Column, hint: Column, pattern: str, value_group: int, keep) -> Column:
    """Spans (start, end, keep, value) of all matches, leftmost and non-overlapping, that keep(value) accepts."""
    every = lambda group: F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def spans(found: Column) -> Column:
        zipped = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)).alias("gap"), found.alias("whole"), (every(value_group) if value_group else found).alias("value"))
        parts = F.transform(zipped, lambda x: F.struct(F.length(x["gap"]).cast("long").alias("gap"), F.length(x["whole"]).cast("long").alias("size"), keep(x["value"]).alias("keep"), x["value"].alias("value")))
        return let(parts, _running)

    none = F.array().cast("array<struct<start:bigint,end:bigint,keep:boolean,value:string>>")
    return F.when(hint, F.filter(let(every(0), spans), lambda s: s["keep"])).otherwise(none)


def _most_bits(value: Column, alphabet: str) -> Column:
    """The greatest entropy of a window of the value's characters that are in the alphabet, in bits."""
    codes = F.filter(F.transform(F.filter(F.split(value, ""), lambda c: c != ""), lambda c: F.instr(F.lit(alphabet), c) - 1), lambda k: k >= 0)
    term = lambda c: F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))

    def run(cs: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            new = F.element_at(cs, i + 1)
            old = F.when(i >= WINDOW, F.element_at(cs, F.greatest(i - WINDOW + 1, F.lit(1)))).otherwise(F.lit(-1))
            n_new = F.element_at(acc["counts"], new + 1)
            n_old = F.when(old >= 0, F.element_at(acc["counts"], F.greatest(old, F.lit(0)) + 1)).otherwise(F.lit(0))
            total = F.when(new == old, acc["total"]).otherwise(acc["total"] + term(n_new + 1) - term(n_new) + F.when(old >= 0, term(n_old - 1) - term(n_old)).otherwise(F.lit(0.0)))
            counts = F.transform(acc["counts"], lambda c, k: c + F.when(k == new, 1).otherwise(0) - F.when(k == old, 1).otherwise(0))
            low = F.when(i >= WINDOW - 1, F.least(acc["low"], total)).otherwise(acc["low"])
            return F.struct(counts.alias("counts"), total.alias("total"), low.alias("low"))

        start = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0.0).alias("total"), F.lit(1e9).alias("low"))
        return F.aggregate(F.sequence(F.lit(0), F.size(cs) - 1), start, step, lambda acc: F.log2(F.lit(float(WINDOW))) - acc["low"] / WINDOW)

    return let(codes, lambda cs: F.when(F.size(cs) >= WINDOW, run(cs)).otherwise(F.lit(0.0)))


def is_random(value: Column, classes: bool = False) -> Column:
    """Whether some window of a candidate has the entropy of a random string of its class, and no allow-list names it.

    classes: those of CLASSES besides hexadecimal and base64, letters alone among them.
    """
    allowed = F.lit(False)
    for p in ALLOWED:
        allowed = allowed | value.rlike(p)
    least = F.lit(BASE64_BITS)
    for p, b in reversed(CLASSES if classes else ()):
        least = F.when(value.rlike(p), b).otherwise(least)
    bits = F.when(value.rlike("^[0-9a-fA-F]+$"), _most_bits(F.lower(value), HEX_ALPHABET) >= HEX_BITS).otherwise(_most_bits(value, BASE64_ALPHABET) >= least)
    kinds = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    return ~allowed & (kinds | value.rlike("^[A-Za-z]+$") if classes else kinds) & bits


def find_secrets(docs: DataFrame, classes: bool = False) -> DataFrame:
    """docs with ``secrets``: array of (start, kind_no, end, kind) in order of start, then kind; code points, end exclusive.

    A null text counts as empty and has none.  Kinds are searched each on its own, so spans of two kinds may overlap: entropy spans
    are added beside the base spans, which all stay, also where they cover the same characters.  Extra
    columns pass through; ``classes`` as in is_random; ``secrets`` and names starting with ``_secret`` are taken.
    """
    text = text_or_empty()
    always = F.lit(True)
    out = (
        docs.withColumn("_secret_assign", _matches(text, text.rlike(ASSIGN_HINT), ASSIGN, 2, lambda v: F.length(v) >= ASSIGN_LEAST))
        .withColumn("_secret_access", _matches(text, text.contains("AKIA"), ACCESS, 0, lambda v: F.length(v) >= ACCESS_LEAST))
        .withColumn("_secret_hex", _matches(text, text.rlike(HEX), HEX, 0, lambda v: always))
        .withColumn("_secret_entropy", _matches(text, text.rlike(CANDIDATE), CANDIDATE, 0, lambda v: is_random(v, classes)))
    )

    def named(k: int, kind: str) -> Column:
        return F.transform(F.col(f"_secret_{kind}"), lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind_no"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    spans = [named(k, kind) for k, kind in enumerate(KINDS)]
    return out.withColumn("secrets", F.array_sort(F.concat(*spans))).drop(*(f"_secret_{k}" for k in KINDS))


def digest(spans: Column) -> Column:
    """kind:start:end of each, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
