"""One query for each text operator, over its whole table: the operator's result reduced to ids, counts and digests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, language, licenses, lines, packing, quality, secret_scan, simhash, substrings, toxicity
from .common import table

VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"), classes=True).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["kind"] != "entropy")
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(secret_scan.digest(base), 256).alias("base_sha256"), secret_scan.digest(F.col("secrets")).alias("spans"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), counted=True)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_best_fit_packing,
        op3_line_dedup,
        op4_simhash_near_dedup,
        op5_license_scan,
        op6_toxicity,
        op7_decontamination,
        op8_quality_rules,
        op9_language_id,
        op10_substring_dedup,
    )
}

_WORDS = r"""list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"""
_SHINGLES = """case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end"""

SQL: dict[str, str] = {
    "op7_decontamination": f"""
with d as (select distinct doc_id, unnest({_SHINGLES}) as s from (select doc_id, {_WORDS} as ws from documents where doc_id is not null)),
b as (select distinct item_id, unnest({_SHINGLES}) as s from (select item_id, {_WORDS} as ws from benchmark where item_id is not null)),
n as (select item_id, count(*) as n_item from b group by item_id)
select doc_id, item_id, count(*) as n_shared, any_value(n_item) as n_item, count(*)::double / any_value(n_item) as containment
from d join b using (s) join n using (item_id) group by doc_id, item_id having count(*) >= ceil(any_value(n_item) * 0.8 - 1e-9)""",
    "op10_substring_dedup": r"""
with d as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
w as (select doc_id, i, sha256(array_to_string(ws[i:i + 19], ' ')) as k from (select doc_id, ws, unnest(range(1, len(ws) - 18)) as i from d where len(ws) >= 20)),
late as (select doc_id, i from (select doc_id, i, row_number() over (partition by k order by doc_id, i) as r from w) where r > 1),
gone as (select doc_id, list(distinct p) as ps from (select doc_id, unnest(range(i, i + 20)) as p from late) group by doc_id),
c as (select d.doc_id, ws, coalesce(ps, []) as ps from d left join gone on d.doc_id = gone.doc_id),
o as (select doc_id, p, word, g.p2 is not null as lost from (select doc_id, unnest(range(1, len(ws) + 1)) as p, unnest(ws) as word from c) x
      left join (select doc_id as d2, unnest(ps) as p2 from gone) g on g.d2 = x.doc_id and g.p2 = x.p)
select d.doc_id, len(d.ws)::bigint as n_words, coalesce(a.n_removed, 0)::bigint as n_removed, sha256(coalesce(a.kept, '')) as kept_sha256
from d left join (select doc_id, count(*) filter (where lost) as n_removed, string_agg(word, ' ' order by p) filter (where not lost) as kept from o group by doc_id) a on a.doc_id = d.doc_id""",
}
