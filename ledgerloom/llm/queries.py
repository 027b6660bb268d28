"""The operators with production parameters over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html_extract, langid, nn_descent, quality_fm, sentencepiece_codec, simhash, suffix_dedup, toxicity
from .common import fold, table
from .mixing import mix_sources
from .quality_rules import robust_outliers


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", F.round("rate", 6).alias("rate"))


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3)


def op4_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_fm.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.apply(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.predict(table(spark, sf_dir, "documents"))
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robust_outliers(table(spark, sf_dir, "documents")).drop("x0", "x1", "x2", "x3", "x4")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "flagged")


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_sentencepiece, op3_simhash, op4_embedding_duplicates, op5_quality_classifier, op6_repeated_passages, op7_language_id, op8_quality_rules, op9_toxicity,
    op10_html_extract,
)}

ORACLE_SQL = {
    "op1_mix_sources": """
with recursive rows_ as (
  select doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))::bigint as size from documents
), sizes as (
  select source, sum(size)::bigint as source_size from rows_ group by source
), weighted as (
  select *, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as w from sizes
), levels as (
  select *, (sum(source_size) over () - 3 * coalesce(sum(source_size) over before, 0))::double
         / (sum(w) over () - coalesce(sum(w) over before, 0))::double as theta, coalesce(sum(source_size) over before, 0) as s0
  from weighted window before as (order by source_size::double / w, source nulls last rows between unbounded preceding and 1 preceding)
), level as (
  select arg_min(theta, (s0, theta)) filter (where 3 * source_size >= theta * w) as theta from levels
), plan as (
  select source, source_size, round(coalesce(least(l.theta * w, (3 * source_size)::double), (3 * source_size)::double), 6) as target from levels, level l
), counts as (
  select source, list({'size': size, 'n': n}) as hs from (select source, size, count(*) as n from rows_ group by all) group by source
), bracket as (
  select p.source, p.target, c.hs, 0 as step, least(ln(target / source_size), 0.0::double) as low, greatest(ln(target / source_size), 0.0::double) as high
  from plan p join counts c on p.source is not distinct from c.source where source_size > 0 and target < 3 * source_size
), halved as (
  select * from bracket union all
  select source, target, hs, step + 1, case when got < target then mid else low end, case when got < target then high else mid end
  from (select *, (low + high) / 2 as mid, list_sum(list_transform(hs, lambda h: h.n * h.size * case when (low + high) / 2 * h.size >= ln(3) then 3.0::double else exp((low + high) / 2 * h.size) end)) as got
        from halved where step < 100)
), tilts as (
  select source, (low + high) / 2 as tilt, true as solved from halved where step = 100
), units as (
  select r.*, p.source_size, p.target, round(case when p.source_size = 0 then 1.0::double when t.solved is null or tilt * size >= ln(3) then 3.0::double else exp(tilt * size) end * 1000000)::bigint as units
  from rows_ r join plan p on r.source is not distinct from p.source left join tilts t on r.source is not distinct from t.source
), celled as (
  select *, units // 1000000 as base, units % 1000000 as part,
         length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0)::bigint) as c1, coalesce(((doc_id % 32) + 32) % 32, -1) as c2
  from units
), placed as (
  select *, sum(part) over (partition by source order by c1, c2, size, doc_id nulls first rows between unbounded preceding and current row)::bigint as cum from celled
), rounded as (
  select *, (cum + 500000) // 1000000 - (cum - part + 500000) // 1000000 as extra from placed
), missing as (
  select *, round(target - sum((base + extra) * size) over (partition by source))::bigint as short from rounded
), opened as (
  select *, (part > 0 and extra <> (case when short > 0 then 1 else 0 end) and short <> 0) as open_ from missing
), summed as (
  select *, sum(case when open_ then size else 0 end) over (partition by source order by c1, c2, size, doc_id nulls first rows between unbounded preceding and current row) as upto from opened
)
select doc_id, size, source_size, target, round(units / 1000000.0::double, 6) as rate,
       ((base + case when open_ and upto <= abs(short) then (case when short > 0 then 1 else 0 end) else extra end) * size)::bigint as taken
from summed
""",
}
