"""More named queries: candidates, routing and evidence, linkage rows, label stores, sampling and measurements, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import identifiers as I  # noqa: N812
from ..functions import signals as S  # noqa: N812
from ..functions import text as T  # noqa: N812
from ..operators import labels, matching, metrics, renewal, retrieval, similarity
from . import queries as base
from .queries import _BT, _DT, _IDF, CUT, STOP_SQL, documents, norm_sql, query, six, table, tok_sql

# Candidates -----------------------------------------------------------------------------------------------------------------------


@query(f"""with {_DT}, {_BT}, {_IDF}, k as (select item_id, token, df <= {CUT} * n as rare, bool_or(df <= {CUT} * n) over (partition by item_id) as any_rare from bt join idf using (token)), p as (select distinct item_id, doc_id from k join dt using (token) where rare or not any_rare),
 w as (select item_id, doc_id, case when len(a) <= len(b) then a else b end as s, case when len(a) <= len(b) then b else a end as l from p join (select item_id, {tok_sql('text')} as a from benchmark) using (item_id) join (select doc_id, {tok_sql('text')} as b from documents) using (doc_id))
select item_id, doc_id, round(100 * list_max(list_transform(range(1, len(l) - len(s) + 2), lambda i: len(list_intersect(s, l[i:i + len(s) - 1])) / len(list_distinct(list_concat(s, l[i:i + len(s) - 1])))::double)), 6) as score from w where len(s) > 0 and len(s) <= 0.5 * len(l)""")
def title_sliding_window(spark, d):
    items = table(spark, d, "benchmark").select("item_id", T.normalize_text(F.col("text")).alias("a"))
    # A document's text meets all its passages in one row; no pair carries it.
    asked = base._pair_keys(spark, d).join(items, "item_id").groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "a")).alias("items"))
    rows = documents(spark, d).select("doc_id", "text").join(asked, "doc_id")
    scores = similarity.exact_windows_udf(T.normalize_long(F.col("text")), F.transform("items", lambda i: i["a"]))
    rows = rows.select("doc_id", F.explode_outer(F.arrays_zip(F.col("items.item_id").alias("item_id"), scores.alias("score"))).alias("s"))
    return rows.select("s.item_id", "doc_id", six(F.col("s.score")).alias("score")).where("score is not null")


@query("select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'P')")
def point_lookup(spark, d):
    wanted = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return retrieval.point_lookup(wanted, table(spark, d, "customer"), "c_custkey").select("c_custkey", "c_name")


@query("""with q as (select o_orderkey, o_orderpriority as token, case when o_orderkey % 5 > 0 then year(o_orderdate) + 1 end as y from orders),
 x as (select c_custkey, c_mktsegment as segment, 1995 + c_custkey % 6 as y, unnest(['1-URGENT', '3-MEDIUM']) as token from customer)
select o_orderkey, count(distinct c_custkey) as candidates from q join x using (token) where abs(q.y - x.y) <= 1 group by 1""")
def candidates_explicit_year(spark, d):
    orders = table(spark, d, "orders")
    asked = orders.select(F.col("o_orderkey").alias("query"), F.lit("title").alias("field"), F.col("o_orderpriority").alias("token"), F.year("o_orderdate").alias("year"), "o_orderkey")
    index = table(spark, d, "customer").select(F.lit("title").alias("field"), F.explode(F.array(F.lit("1-URGENT"), F.lit("3-MEDIUM"))).alias("token"), (1995 + F.col("c_custkey") % 6).cast("int").alias("year"), "c_custkey")
    found = retrieval.candidate_counts(asked, index, F.when(F.col("o_orderkey") % 5 > 0, F.col("year") + 1), 1)
    return found.select(F.col("query").alias("o_orderkey"), "candidates")


# Evidence -------------------------------------------------------------------------------------------------------------------------

_TITLE = "case p_partkey % 8 when 0 then 'Annals. Vol. ' || p_size when 1 then 'Annals, Vols. 1-4' when 2 then 'Annals. Vol. 1 and Vol. ' || (p_size + 1) when 3 then 'Collected Essays' when 4 then 'Annals, IV: the sea' when 5 then 'Annals of ' || p_brand else 'Annals' end"


@query(f"""with r as (select p_partkey, p_size, p_partkey % 8 as m, p_partkey % 5 as e, {_TITLE} as t from part),
 k as (select *, case when e = 0 then 'whole_open' when e = 1 or m = 3 then 'whole' when m in (0, 2) then 'part' else 'unknown' end as kind_a, case when m in (1, 2, 3) then 'whole' when m in (0, 4) then 'part' when e = 1 then 'whole' else 'unknown' end as kind_b from r)
select p_partkey, kind_a, case when kind_a = 'part' then case when m = 0 then p_size::varchar else '1' end end as part_a, kind_b, case when kind_b = 'part' then case when m = 0 then p_size::varchar else 'iv' end end as part_b, (m = 2) as enumerates from k""")
def volume_kinds(spark, d):
    m, e, n = F.col("p_partkey") % 8, F.col("p_partkey") % 5, F.col("p_size")
    title = (
        F.when(m == 0, F.concat(F.lit("Annals. Vol. "), n.cast("string"))).when(m == 1, "Annals, Vols. 1-4").when(m == 2, F.concat(F.lit("Annals. Vol. 1 and Vol. "), (n + 1).cast("string"))).when(m == 3, "Collected Essays")
        .when(m == 4, "Annals, IV: the sea").when(m == 5, F.concat(F.lit("Annals of "), "p_brand")).otherwise("Annals")
    )
    extent = F.when(e == 0, ". v").when(e == 1, "5 v. in 10").otherwise("310 p.")
    none = F.lit(None).cast("string")
    rows = base.dealt(table(spark, d, "part")).select("p_partkey", F.when((m == 1) | (m == 4), "Annals").otherwise(title).alias("title"), title.alias("other"), extent.alias("extent"), none.alias("title_part_number"), none.alias("publication_date_raw"))
    rows = rows.withColumn("a", matching.marc_volume()).drop("title").withColumnRenamed("other", "title").withColumn("desc", F.when(e == 1, "5 v. in 10").otherwise("310 p.")).withColumn("notes", F.array().cast("array<string>"))
    rows = rows.withColumn("b", matching.cce_volume(F.array().cast("array<string>")))
    return rows.select("p_partkey", F.col("a.kind").alias("kind_a"), F.col("a.part").alias("part_a"), F.col("b.kind").alias("kind_b"), F.col("b.part").alias("part_b"), S.enumerates_parts(F.col("title")).alias("enumerates"))


@query(f"""with t as (select doc_id, {tok_sql('text')} as a, {tok_sql('source')} as b from documents) select doc_id, (len(list_distinct(b)) > 0 and list_has_all(a, b) and len(list_distinct(a)) > len(list_distinct(b))) as extends from t""")
def title_extends(spark, d):
    return documents(spark, d).select("doc_id", S.extends(T.tokenize(F.col("text")), T.tokenize(F.col("source"))).alias("extends"))


@query(f"""with t as (select doc_id, {tok_sql('text')} as w, {tok_sql("coalesce(lang, '') || ' the of and ' || coalesce(source, '')")} as e from documents), k as (select doc_id, w, list_filter(w, lambda x: not list_contains(e, x) or x = 'and') as kept from t)
select doc_id, len(case when len(kept) > 0 then kept else w end)::bigint as n, array_to_string(list_sort(list_distinct(case when len(kept) > 0 then kept else w end)), ' ') as words from k""")
def cross_field_strip(spark, d):
    explained = T.tokenize(F.concat_ws("", F.coalesce("lang", F.lit("")), F.lit(" the of and "), F.coalesce("source", F.lit(""))))
    entries = F.transform(T.long_words(F.col("text")), lambda w: F.struct(w.alias("word"), F.lit(1.0).alias("weight")))
    rows = documents(spark, d).select("doc_id", matching.unexplained(entries, F.array(F.lit("and")), explained).alias("p")).select("doc_id", F.transform("p", lambda p: p["word"]).alias("w"))
    return rows.select("doc_id", F.size("w").cast("long").alias("n"), F.array_join(F.sort_array(F.array_distinct("w")), " ").alias("words"))


_ROUTE = """scored as (select o_custkey as control_id, o_orderkey as uuid, (o_orderkey % 101)::double as author, (o_orderkey * 7 % 101)::double as publisher, o_orderkey % 3 <> 0 as claimed from orders)"""


@query(f"with {_ROUTE} select control_id, uuid, case when author >= publisher then 'author' else 'publisher' end as route from scored where claimed and greatest(author, publisher) >= 70")
def claimant_routing(spark, d):
    k = F.col("o_orderkey")
    entry = lambda group, field, score: F.struct(F.lit(group).alias("grp"), F.lit(field).alias("field_a"), score.cast("double").alias("score"))
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("control_id"), k.alias("uuid"), F.explode(F.array(entry("author", "main_author", k % 101), entry("publisher", "publisher", k * 7 % 101))).alias("e"))
    rows = rows.select("control_id", "uuid", "e.*", F.lit("claimants").alias("field_b"), F.col("uuid").cast("string").alias("vkey_b"), F.lit(False).alias("skipped"))
    claimed = table(spark, d, "orders").where(k % 3 != 0).select(k.alias("uuid"), k.cast("string").alias("vkey_b"))
    return matching.routed_claimants(rows, claimed).select("control_id", "uuid", F.col("to").alias("route"))


@query("""with r as (select s_suppkey, i, case when i = 0 then 'publisher_names' when i = 1 then 'claimants' else 'author_name' end as field, case when i = 1 then 'Reed Publishing Company' else s_name end as value, s_suppkey % 2 = 0 as blank, (s_suppkey * (i + 3) % 97)::double as score from supplier, range(0, 3) t(i)),
 g as (select *, blank and field <> 'publisher_names' and i <> 1 as gate from r)
select s_suppkey, i, gate, case when gate then 0.0 else score end as score from g""")
def blank_publisher_gate(spark, d):
    names = F.col("s_name")
    rows = table(spark, d, "supplier").select("s_suppkey", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))).alias("i"), "s_name")
    rows = rows.select(F.col("s_suppkey").alias("uuid"), "s_suppkey", "i", F.lit("publisher").alias("grp"), F.when(F.col("i") == 0, "publisher_names").when(F.col("i") == 1, "claimants").otherwise("author_name").alias("field_b"),
                       F.when(F.col("i") == 1, "Reed Publishing Company").otherwise(names).alias("value_b"), F.lit(False).alias("skipped"), (F.col("s_suppkey") * (F.col("i") + 3) % 97).cast("double").alias("score"))
    cce = table(spark, d, "supplier").select(F.col("s_suppkey").alias("uuid"), F.when(F.col("s_suppkey") % 2 == 0, F.array(F.lit(" "))).otherwise(F.array(names)).alias("publisher_names"))
    return matching.gated(rows, cce).select("s_suppkey", "i", "gate", "score")


@query("""with r as (select l_orderkey, l_linenumber, l_suppkey % 3 as g, (l_quantity)::double as score, l_linenumber % 4 = 0 as skipped from lineitem),
 b as (select l_orderkey, g, arg_max(l_linenumber, (score, -l_linenumber)) filter (where not skipped) as line, max(score) filter (where not skipped) as score from r group by all)
select l_orderkey, (['title', 'author', 'publisher'])[g::int + 1] as grp, coalesce(score, 0.0) as score, score is null as skipped, coalesce('f:' || line, '') as source from b""")
def best_evidence(spark, d):
    n = F.col("l_linenumber")
    rows = table(spark, d, "lineitem").select(
        F.lit("m").alias("control_id"), F.col("l_orderkey").alias("uuid"), F.element_at(F.array(*map(F.lit, matching.GROUPS)), (F.col("l_suppkey") % 3 + 1).cast("int")).alias("grp"), F.col("l_quantity").alias("score"), (n % 4 == 0).alias("skipped"),
        F.lit("f").alias("field_a"), n.cast("string").alias("field_b"), n.alias("place"), F.lit(0).alias("at_a"), F.lit(0).alias("at_b"), F.lit(False).alias("mismatch"), F.lit(None).cast("int").alias("t"), F.lit(0).alias("overlap"),
        F.lit("").alias("value_a"), F.lit("").alias("value_b"))
    return matching.best_of_groups(rows).select(F.col("uuid").alias("l_orderkey"), "grp", "score", "skipped", "source")


_MARC_SQL = f"select item_id, 'Item ' || item_id || ' Sea-Port' as title, (1900 + item_id % 90)::int as year, case when item_id % 3 = 0 then '50-' || item_id end as lccn from benchmark"
_LINK_SQL = f"""with {base._TOP}, best as (select * from best3 where rank = 1), m as ({_MARC_SQL}), c as (select doc_id, coalesce(source, '') as title, lang as author, (1900 + doc_id % 90)::int as year from documents),
 j as (select m.*, best.doc_id, best.calibrated, c.title as ct, c.author as ca, c.year as cy from m left join best using (item_id) left join c using (doc_id))
select item_id::varchar as marc_id, title as marc_title_original, {norm_sql('title')} as marc_title_normalized, {norm_sql('title')} as marc_title_stemmed, '' as marc_author_original, '' as marc_author_normalized, '' as marc_author_stemmed,
 '' as marc_main_author_original, '' as marc_main_author_normalized, '' as marc_main_author_stemmed, '' as marc_publisher_original, '' as marc_publisher_normalized, '' as marc_publisher_stemmed, year::varchar as marc_year, coalesce(lccn, '') as marc_lccn,
 coalesce('50' || lpad(item_id::varchar, greatest(6, length(item_id::varchar)), '0'), '') as lccn_full, case when lccn is null then '' else '50' || case when length(item_id::varchar) < 6 then lpad(item_id::varchar, 6, '0') else item_id::varchar end end as marc_lccn_normalized,
 'nyu' as marc_country_code, 'eng' as marc_language_code, case when doc_id is null then '' else 'registration' end as match_type, coalesce(ct, '') as match_title, coalesce({norm_sql('ct')}, '') as match_title_normalized, coalesce(ca, '') as match_author,
 coalesce({norm_sql('ca')}, '') as match_author_normalized, case when doc_id is null then '' else 'Fen House' end as match_publisher, case when doc_id is null then '' else 'fen house' end as match_publisher_normalized, coalesce(cy::varchar, '') as match_year,
 coalesce(doc_id::varchar, '') as match_source_id, coalesce(cy::varchar, '') as match_date, coalesce('A' || doc_id, '') as match_regnum, case when doc_id is null then '' else 'A1; A2' end as match_prev_regnums,
 case when doc_id is null then '' when doc_id % 2 = 0 then 'true' else 'false' end as match_was_renewed, coalesce(case when doc_id % 2 = 0 then 'R' || doc_id when doc_id % 3 = 0 then 'S' || doc_id end, '') as match_renewal_id,
 case when doc_id % 2 = 0 then '1978-01-02' else '' end as match_renewal_date, case when doc_id % 2 = 0 then 'direct' when doc_id % 3 = 0 then 'sibling' else '' end as match_renewal_via,
 case when doc_id is null then '' else '88' end as title_score, case when doc_id is null then '' else '4' end as author_score, '' as publisher_score, coalesce(printf('%.2f', calibrated * 100 + 1e-9), '') as combined_score, coalesce((year - cy)::varchar, '') as year_difference from j"""


@query(_LINK_SQL.replace(" coalesce('50' || lpad(item_id::varchar, greatest(6, length(item_id::varchar)), '0'), '') as lccn_full,", ""))
def linkage_rows(spark, d):
    k, n, none = F.col("item_id"), F.col("doc_id"), F.lit(None).cast("string")
    marc = table(spark, d, "benchmark").select(
        k.cast("string").alias("control_id"), F.concat(F.lit("Item "), k.cast("string"), F.lit(" Sea-Port")).alias("title"), none.alias("statement_of_responsibility"), none.alias("main_author"), none.alias("publisher"),
        (1900 + k % 90).cast("int").alias("publication_year"), F.when(k % 3 == 0, F.concat(F.lit("50-"), k.cast("string"))).alias("lccn"), F.lit("nyu").alias("country_code"), F.lit("eng").alias("language_code"))
    renewed = n % 2 == 0
    cce = table(spark, d, "documents").select(
        n.cast("string").alias("uuid"), F.coalesce("source", F.lit("")).alias("title"), F.col("lang").alias("author_name"), F.array(F.lit("Fen House")).alias("publisher_names"), (1900 + n % 90).cast("int").alias("reg_year"),
        F.lit(None).cast("date").alias("reg_date"), F.concat(F.lit("A"), n.cast("string")).alias("regnum"), F.array(F.lit("A1"), F.lit("A2")).alias("prev_regnums"), renewed.alias("was_renewed"), F.when(renewed, F.concat(F.lit("R"), n.cast("string"))).alias("renewal_id"),
        F.when(renewed, F.lit("1978-01-02").cast("date")).alias("renewal_date"), F.when(~renewed & (n % 3 == 0), F.concat(F.lit("S"), n.cast("string"))).alias("sibling_renewal"))
    score = lambda v, skipped: F.struct(F.lit(v).alias("score"), F.lit(skipped).alias("skipped"))
    best = base._top(spark, d).select(k.cast("string").alias("control_id"), n.cast("string").alias("uuid"), "rank", "calibrated", score(87.5, False).alias("title"), score(4.5, False).alias("author"), score(0.0, True).alias("publisher"))
    return matching.linkage(marc, cce, best)


@query()
def match_records(spark, d):
    """The whole match query over passages as catalogue records and documents as registrations: every candidate within the year, with its evidence."""
    from .. import config

    k, n, none = F.col("item_id"), F.col("doc_id"), F.lit(None).cast("string")
    nothing = F.array().cast("array<string>")
    marc = table(spark, d, "benchmark").select(
        k.cast("string").alias("control_id"), F.col("text").alias("title"), F.substring_index("text", " ", 8).alias("title_main"), none.alias("title_part_number"), none.alias("title_part_name"), F.substring_index("text", " ", 2).alias("main_author"),
        none.alias("statement_of_responsibility"), none.alias("publisher"), none.alias("place"), nothing.alias("series_titles"), none.alias("edition"), none.alias("extent"), none.alias("publication_date_raw"), (1900 + k % 30).cast("int").alias("publication_year"),
        none.alias("lccn"), nothing.alias("isbns"), F.lit("eng").alias("language_code"))
    cce = table(spark, d, "documents").select(
        n.cast("string").alias("uuid"), F.col("text").alias("title"), F.substring_index("text", " ", 2).alias("author_name"), F.array("source").alias("publisher_names"), F.array("source").alias("claimants"), none.alias("renewal_author"), none.alias("renewal_title"), none.alias("renewal_claimants"),
        none.alias("edition"), none.alias("desc"), nothing.alias("notes"), none.alias("new_matter_claimed"), none.alias("renewal_new_matter"), none.alias("lccn"), (1900 + n % 30).cast("int").alias("reg_year"), F.lit(False).alias("is_range_registration"))
    pairs = base._pair_keys(spark, d).where(F.pmod(k, F.lit(30)) == F.pmod(n, F.lit(30))).select(k.cast("string").alias("control_id"), n.cast("string").alias("uuid"))
    matched = matching.match(marc, cce, pairs, config.MatchingConfig(), config.default_pairings())
    return matched.select("control_id", "uuid", six(F.col("title.score")).alias("title"), six(F.col("author.score")).alias("author"), six(F.col("raw")).alias("raw"), six(F.col("calibrated")).alias("calibrated"))


# Labels and sampling --------------------------------------------------------------------------------------------------------------

_VAULT = "vault as (select event_id, user_id as marc_control_id, event_id % 50 as nypl_uuid, case event_type when 'error' then 'unsure' when 'view' then 'no_match' else 'match' end as verdict, case when event_id % 7 = 0 then 'renewal' when event_id % 11 > 0 then 'registration' end as match_source, ts from events)"


def _vault(spark, d):
    k = F.col("event_id")
    return table(spark, d, "events").select(
        k, F.col("user_id").alias("marc_control_id"), (k % 50).alias("nypl_uuid"), F.when(F.col("event_type") == "error", "unsure").when(F.col("event_type") == "view", "no_match").otherwise("match").alias("verdict"),
        F.when(k % 7 == 0, "renewal").when(k % 11 > 0, "registration").alias("match_source"), "ts")


@query(f"with {_VAULT} select marc_control_id, arg_max(nypl_uuid, event_id) as nypl_uuid from vault where verdict = 'match' and coalesce(match_source, 'registration') <> 'renewal' group by 1")
def truth_of_labels(spark, d):
    return labels.truth_of(labels.gold_labels(_vault(spark, d)), "event_id")


@query(f"with {_VAULT} select count(*) as pairs, count(*) filter (where c.c_custkey is null) as no_marc, count(*) filter (where c.c_custkey is not null and s.s_suppkey is null) as no_cce, count(*) filter (where c.c_custkey is not null and s.s_suppkey is not null) as resolved from vault left join customer c on marc_control_id = c_custkey left join supplier s on nypl_uuid = s_suppkey")
def vault_resolve(spark, d):
    marc, cce = table(spark, d, "customer").select(F.col("c_custkey").alias("control_id")), table(spark, d, "supplier").select(F.col("s_suppkey").alias("uuid"))
    return labels.resolved(_vault(spark, d), marc, cce)[1]


@query(f"with {_VAULT} select verdict, count(*) as n from vault where verdict in ('unsure', 'no_match') group by 1")
def requeue_counts(spark, d):
    return labels.requeued(_vault(spark, d), ("unsure", "no_match"))[1]


@query("select p_partkey from part where list_has_any([p_brand, p_type, p_name], ['Brand#11', 'Brand#13']) and contains(lower(p_name), 'a')")
def label_filters(spark, d):
    rows = table(spark, d, "part").withColumn("categories", F.array("p_brand", "p_type", "p_name"))
    return labels.listed(rows, contains="A", fields=("p_name",), categories=("Brand#11", "Brand#13")).select("p_partkey")


_SCORED_PAIRS = "s as (select o_custkey, o_orderkey, (o_orderkey * 37 % 1000) / 1000.0::double as a, (o_orderkey * 61 % 1000) / 1000.0::double as b from orders)"
_DUAL = f"""{_SCORED_PAIRS}, p as (select o_custkey, arg_min(o_orderkey, (-a, o_orderkey)) as a_pick, max(a) as a_score, arg_min(o_orderkey, (-b, o_orderkey)) as b_pick, max(b) as b_score from s group by 1),
 g as (select *, abs(a_score - b_score) + case when a_pick = b_pick then 0 else 1 end as gap, case when a_pick = b_pick and a_score >= 0.7 and b_score >= 0.7 then 'agree_high' when a_pick = b_pick and a_score <= 0.3 and b_score <= 0.3 then 'agree_low' else 'informative' end as bucket from p)"""


def _dual(spark, d):
    k = F.col("o_orderkey")
    return labels.dual_scores(table(spark, d, "orders").select("o_custkey", k, (k * 37 % 1000 / F.lit(1000.0)).alias("a"), (k * 61 % 1000 / F.lit(1000.0)).alias("b")), "o_custkey", "o_orderkey", "a", "b")


@query(f"with {_DUAL} select o_custkey, a_pick, b_pick, round(gap, 6) as gap, bucket from g")
def dual_scores(spark, d):
    return _dual(spark, d).select("o_custkey", "a_pick", "b_pick", six(F.col("gap")).alias("gap"), "bucket")


@query(f"with {_DUAL} select o_custkey, round(gap, 6) as gap from g order by gap desc, o_custkey limit 50")
def most_informative(spark, d):
    return labels.most_informative(_dual(spark, d), "o_custkey").limit(50).select("o_custkey", six(F.col("gap")).alias("gap"))


@query(f"with {_DUAL}, t as (select o_custkey, min(o_orderkey) as truth from orders group by 1), k as (select case when a_pick = truth and b_pick = truth then 'both_right' when a_pick = truth then 'first_right' when b_pick = truth then 'second_right' else 'both_wrong' end as kind from g join t using (o_custkey)) select kind, count(*) as n from k group by 1")
def disagreement_scan(spark, d):
    truth = table(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("truth"))
    return labels.disagreements_of_labels(_dual(spark, d), truth, "o_custkey", "a", "b")


_BUDGET_SQL = "budget as (select * from (values " + ", ".join(f"('{lang}', '{band}', {cap})" for lang, bands in labels.BUDGET.items() for band, cap in bands.items()) + ") t(language, band, cap))"


@query(f"with {_BUDGET_SQL} select language, band, greatest(1, round_even(cap * (580 / 2320.0::double), 0))::int as cap from budget")
def budget_caps(spark, d):
    return labels.budget_table(spark, 580)


@query("select language, greatest(1, round_even(weight * 90, 0))::int as target from (values ('eng', 0.70::double), ('fre', 0.075), ('ger', 0.075), ('ita', 0.075), ('spa', 0.075)) t(language, weight)")
def language_targets(spark, d):
    return labels.language_targets(spark, 90)


_LANGUAGE = "case lang when 'en' then 'eng' when 'fr' then 'fre' when 'de' then 'ger' else 'spa' end"


@query(f"""with t as (select language, greatest(1, round_even(weight * 90, 0))::int as target from (values ('eng', 0.70::double), ('fre', 0.075), ('ger', 0.075), ('ita', 0.075), ('spa', 0.075)) t(language, weight)), known as (select distinct doc_id from labels),
 r as (select {_LANGUAGE} as language, known.doc_id is not null as known, n_chars % 10 = 0 as undated from documents left join known using (doc_id)), c as (select language, count(*) filter (where known) as excluded, count(*) filter (where not known and undated) as out_of_scope, count(*) filter (where not known and not undated) as open_ from r group by 1)
select language, target, least(target, coalesce(open_, 0))::int as selected, coalesce(excluded, 0) as excluded, coalesce(out_of_scope, 0) as out_of_scope from t left join c using (language)""")
def record_selection(spark, d):
    language = F.when(F.col("lang") == "en", "eng").when(F.col("lang") == "fr", "fre").when(F.col("lang") == "de", "ger").otherwise("spa")
    records = table(spark, d, "documents").select("doc_id", language.alias("language"), F.when(F.col("n_chars") % 10 != 0, 1950).alias("publication_year"))
    known, targets = table(spark, d, "labels").select("doc_id"), labels.language_targets(spark, 90)
    drawn = labels.selected_records(records, known, targets, "doc_id").groupBy("language").agg(F.count(F.lit(1)).cast("int").alias("drawn"))
    plan = labels.selection_plan(records, known, targets, "doc_id").join(drawn, "language", "left")
    return plan.select("language", "target", F.coalesce("drawn", F.lit(0)).alias("selected"), "excluded", "out_of_scope")


@query(f"""with {_BUDGET_SQL}, r as (select {_LANGUAGE} as language, doc_id, (n_chars % 1000) / 1000.0::double as s from documents anti join labels using (doc_id)), b as (select *, case when s >= 0.9 then 'ge90' when s >= 0.8 then 'b80_90' when s >= 0.7 then 'b70_80' when s >= 0.6 then 'b60_70' else 'below' end as band from r),
 n as (select language, band, count(*) as n, min(cap) as cap, min(doc_id) as first_id from b join budget using (language, band) group by all) select language, band, least(n, cap)::int as n, case when band <> 'below' then first_id end as first_id from n""")
def label_queue(spark, d):
    language = F.when(F.col("lang") == "en", "eng").when(F.col("lang") == "fr", "fre").when(F.col("lang") == "de", "ger").otherwise("spa")
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("control_id"), F.lit("u").alias("uuid"), language.alias("language"), (F.col("n_chars") % 1000 / F.lit(1000.0)).alias("calibrated"), F.col("doc_id").alias("seq"))
    done = table(spark, d, "labels").select(F.col("doc_id").alias("marc_control_id"), F.lit("u").alias("nypl_uuid"))
    queue = labels.build_queue(rows, done, labels.budget_table(spark))
    return queue.groupBy("language", "band").agg(F.count(F.lit(1)).cast("int").alias("n"), F.min("control_id").alias("_f")).select("language", "band", "n", F.when(F.col("band") != "below", F.col("_f")).alias("first_id"))


@query("select lang as language, case when n_chars % 1000 >= 900 then 'ge90' when n_chars % 1000 >= 800 then 'b80_90' when n_chars % 1000 >= 700 then 'b70_80' when n_chars % 1000 >= 600 then 'b60_70' else 'below' end as band, count(*) as n from documents group by all")
def stratum_counts(spark, d):
    return labels.stratum_counts(table(spark, d, "documents").select(F.col("lang").alias("language"), S.score_band((F.col("n_chars") % 1000) / F.lit(1000.0)).alias("band")))


@query("""with v as (select o_orderkey, 1 + o_orderkey % 9 as schema, case when o_orderkey % 4 > 0 then o_orderpriority else '' end as category, case when o_orderkey % 3 = 0 then 1970 end as renewal_year from orders)
select o_orderkey, greatest(schema, 8)::int as schema, case when schema < 3 then case when category = '' then '' else category end else '' end as categories, case when schema < 5 then renewal_year is not null end as was_renewed, case when schema < 8 then 'registration' end as match_source from v""")
def vault_migrate(spark, d):
    k, none = F.col("o_orderkey"), F.lit(None)
    store = table(spark, d, "orders").select(k, (1 + k % 9).cast("int").alias("schema"), F.when(k % 4 > 0, F.col("o_orderpriority")).otherwise("").alias("category"), F.when(k % 3 == 0, 1970).alias("renewal_year"),
                                             none.cast("array<string>").alias("categories"), none.cast("int").alias("reg_year"), none.cast("boolean").alias("was_renewed"), none.cast("string").alias("match_source"))
    return labels.migrate(store).select("o_orderkey", "schema", F.coalesce(F.array_join("categories", ","), F.lit("")).alias("categories"), "was_renewed", "match_source")


@query("select s_suppkey as nypl_uuid, 'A' || s_suppkey as cce_regnum, 1950 + s_nationkey as reg_year, s_suppkey % 2 = 0 as was_renewed, case when s_suppkey % 2 = 0 then 1978 end::int as renewal_year, round(s_acctbal / 7, 4) as weighted_mean, 'v9' as matcher_version from supplier")
def vault_enrich(spark, d):
    k = F.col("s_suppkey")
    cce = table(spark, d, "supplier").select(k.alias("uuid"), F.concat(F.lit("A"), k.cast("string")).alias("regnum"), (1950 + F.col("s_nationkey")).alias("reg_year"), F.when(k % 2 == 0, True).alias("was_renewed"), F.lit("R").alias("renewal_id"), F.when(k % 2 == 0, F.lit("1978-03-01").cast("date")).alias("renewal_date"))
    vault = table(spark, d, "supplier").select(k.alias("nypl_uuid"), F.lit("m").alias("marc_control_id"), F.lit("old").alias("matcher_version"))
    scores = table(spark, d, "supplier").select(k.alias("nypl_uuid"), F.lit("m").alias("marc_control_id"), (F.col("s_acctbal") / 7).alias("weighted_mean"), F.lit(None).cast("double").alias("learned"))
    return labels.enriched(vault, cce, scores, "v9").select("nypl_uuid", "cce_regnum", "reg_year", "was_renewed", "renewal_year", F.col("scores.weighted_mean").alias("weighted_mean"), "matcher_version")


# Measurements ---------------------------------------------------------------------------------------------------------------------

_REGS = "regs as (select o_orderkey as id, 'A-' || o_orderkey as raw, 'A' || o_orderkey as norm, o_orderdate::date as day, year(o_orderdate) as y from orders)"
_RENS = "rens as (select l_orderkey * 10 + l_linenumber as id, case when l_linenumber = 1 then 'A-' else 'A ' end || l_orderkey as raw, 'A' || l_orderkey as norm, case when l_linenumber < 3 then o_orderdate::date else l_shipdate::date end as day from lineitem join orders on l_orderkey = o_orderkey)"


@query(f"""with {_REGS}, {_RENS}, a as (select id, unnest(['raw_day', 'norm_day', 'norm_year', 'norm']) as scheme, unnest([raw || '|' || day, norm || '|' || day, norm || '|' || y, norm]) as k from regs),
 b as (select id, unnest(['raw_day', 'norm_day', 'norm_year', 'norm']) as scheme, unnest([raw || '|' || day, norm || '|' || day, norm || '|' || year(day), norm]) as k from rens), m as (select scheme, k, count(distinct id) as m from a group by all)
select scheme, count(distinct id) as joined, count(*) filter (where m = 1) as single from b join m using (scheme, k) group by 1""")
def join_schemes(spark, d):
    k = lambda c: F.col(c).cast("string")
    orders = table(spark, d, "orders")
    regs = orders.select(F.col("o_orderkey").alias("id"), F.concat(F.lit("A-"), k("o_orderkey")).alias("raw"), F.concat(F.lit("A"), k("o_orderkey")).alias("norm"), F.to_date("o_orderdate").alias("day"), F.year("o_orderdate").alias("year"))
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate").join(orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    day = F.to_date(F.when(F.col("l_linenumber") < 3, F.col("o_orderdate")).otherwise(F.col("l_shipdate")))
    raw = F.concat(F.when(F.col("l_linenumber") == 1, "A-").otherwise("A "), k("l_orderkey"))
    rens = items.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), raw.alias("raw"), F.concat(F.lit("A"), k("l_orderkey")).alias("norm"), day.alias("day"), F.year(day).alias("year"))
    return renewal.joined_by_scheme(regs, rens)


@query(f"with r as (select {base._RAW_SQL} as raw from orders), n as (select raw, {base._NORM_REG.format(raw='raw')} as regnum from r) select regexp_extract(regexp_replace(upper(trim(raw)), '[^A-Z0-9]', '', 'g'), '^[A-Z]*') as class, regexp_extract(regnum, '^[A-Z]+') as folded, count(*) as n from n group by all")
def class_folds(spark, d):
    return renewal.class_folds(table(spark, d, "orders").select(base._raw_regnum().alias("raw")), "raw")


@query(f"with r as (select {base._RAW_SQL} as raw from orders), p as (select string_split_regex(trim(raw), '\\s+') as parts from r) select len(parts)::int as size, count(*) as n from p where len(parts) > 1 and len(list_filter(parts, lambda t: not regexp_full_match(upper(t), '[A-Z]*[0-9]+'))) = 0 group by 1")
def range_sizes(spark, d):
    return renewal.range_sizes(table(spark, d, "orders").select(base._raw_regnum().alias("raw")), "raw")


@query("with h as (select l_orderkey, min(l_linenumber - 1) as p from lineitem where l_linenumber % 3 > 0 group by 1) select count(*) filter (where p = 0) as own, count(*) filter (where p > 0) as additional from h")
def additional_entry_joins(spark, d):
    return renewal.recovered(table(spark, d, "lineitem").where("l_linenumber % 3 > 0").select("l_orderkey", (F.col("l_linenumber") - 1).alias("place")), "l_orderkey")


@query("with s as (select event_type, event_id % 2 as label, (event_id * 37 % 100) / 100.0::double as score from events) select event_type, count(*) as n, round(avg(case when (score >= 0.5)::int = label then 1.0 else 0.0 end)::double, 6) as accuracy from s group by 1")
def category_accuracy(spark, d):
    k = F.col("event_id")
    rows = table(spark, d, "events").select("event_type", (k % 2).cast("int").alias("label"), (k * 37 % 100 / F.lit(100.0)).alias("score"))
    return metrics.accuracy_by_category(rows, "event_type").select("event_type", "n", six(F.col("accuracy")).alias("accuracy"))


@query("""with t as (select event_id, date_diff('second', ts, timestamp '2024-02-01') as s from events) select event_id, case when s < 60 then 'just now' when s < 3600 then (s // 60) || 'm ago' when s < 86400 then (s // 3600) || 'h ago' when s < 604800 then (s // 86400) || 'd ago' else (s // 604800) || 'w ago' end as ago from t""")
def relative_times(spark, d):
    return table(spark, d, "events").select("event_id", T.relative_time(F.col("ts").cast("timestamp"), F.lit("2024-02-01").cast("timestamp")).alias("ago"))


@query("""select c_custkey, case when c_custkey % 3 = 0 then 'https://www.worldcat.org/oclc/' || c_custkey end as oclc, case when c_custkey % 2 = 0 then 'https://lccn.loc.gov/' || c_custkey end as lccn,
 case when c_custkey % 3 = 0 then 'https://catalog.hathitrust.org/api/volumes/oclc/' || c_custkey || '.html' when c_custkey % 2 = 0 then 'https://catalog.hathitrust.org/api/volumes/lccn/' || c_custkey || '.html' else 'https://catalog.hathitrust.org/api/volumes/isbn/' || c_custkey || '.html' end as volume from customer""")
def external_urls(spark, d):
    k, text = F.col("c_custkey"), F.col("c_custkey").cast("string")
    oclc, lccn = F.when(k % 3 == 0, text), F.when(k % 2 == 0, text).otherwise("")
    return table(spark, d, "customer").select(k, I.oclc_url(oclc).alias("oclc"), I.lccn_url(lccn).alias("lccn"), I.external_url(oclc, lccn, text).alias("volume"))


@query(f"""with t as (select doc_id, list_filter({tok_sql('text')}, lambda x: not list_contains({STOP_SQL}, x)) as w, {tok_sql("coalesce(lang, '') || ' ' || coalesce(source, '')")} as h from documents), p as (select 'publisher' as field, doc_id, unnest(list_distinct(h)) as token from t union all select 'title', doc_id, unnest(list_distinct(w)) from t)
select field, count(*) as postings, count(distinct token) as tokens from p group by 1""")
def postings_of_claimants(spark, d):
    docs = documents(spark, d)
    both = F.array_union(T.tokenize(F.col("lang")), T.tokenize(F.col("source")))
    rows = retrieval.postings(docs, {"title": T.token_keys(F.col("text")), "publisher": both}, "doc_id")
    return rows.groupBy("field").agg(F.count(F.lit(1)).alias("postings"), F.countDistinct("token").alias("tokens"))
