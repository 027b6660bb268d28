"""Named queries over the shared tables, each with the SQL that gives the same rows.

`query(sql)` registers a function under its name. Doubles are rounded to six places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identifiers as I  # noqa: E741, N812
from ..functions import numbers as N  # noqa: N812
from ..functions import signals as S  # noqa: N812
from ..functions import text as T  # noqa: N812
from ..operators import labels, metrics, renewal, retrieval, scoring, similarity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def documents(spark: SparkSession, d: str) -> DataFrame:
    """The documents, dealt out over all cores where their scan has fewer splits than there are cores.

    Normalising text is bound by CPU. Larger inputs have more splits (spark.sql.files.maxPartitionBytes) than cores and are left as they are.
    """
    return dealt(table(spark, d, "documents"))


def dealt(rows: DataFrame) -> DataFrame:
    """rows dealt out over all cores where their scan has fewer splits than there are cores."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def six(c: Column) -> Column:
    return F.round(c.cast("double"), 6)


STOP = T.all_stopwords()
STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP) + "]"


def norm_sql(c: str) -> str:
    return f"trim(regexp_replace(strip_accents(lower({c})), '[^0-9a-z]+', ' ', 'g'))"


def tok_sql(c: str) -> str:
    return f"list_filter(string_split({norm_sql(c)}, ' '), lambda t: t <> '')"


def map_sql(table_: dict[str, object]) -> str:
    lit = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return "map {" + ", ".join(f"'{k}': {lit(v)}" for k, v in table_.items()) + "}"


# Text -----------------------------------------------------------------------------------------------------------------------------


@query(f"select doc_id, {norm_sql('text')} as norm, len({tok_sql('text')})::bigint as n_tokens from documents")
def normalize_text_docs(spark, d):
    return documents(spark, d).select("doc_id", T.normalize_text(F.col("text")).alias("norm"), F.size(T.tokenize(F.col("text"))).cast("long").alias("n_tokens"))


@query(f"select doc_id, array_to_string(list_sort(list_filter(list_distinct({tok_sql('text')}), lambda t: not list_contains({STOP_SQL}, t))), ' ') as keys from documents")
def token_keys_docs(spark, d):
    return documents(spark, d).select("doc_id", F.array_join(F.sort_array(T.token_keys(F.col("text"))), " ").alias("keys"))


@query(f"select turn, role, array_to_string(list_sort(list_distinct({tok_sql('text')})), ' ') as value_key, count(*) as n from conversations group by all")
def value_keys(spark, d):
    return table(spark, d, "conversations").groupBy("turn", "role", T.value_key(F.col("text")).alias("value_key")).agg(F.count(F.lit(1)).alias("n"))


@query("select page_id, coalesce(regexp_extract(html, '<title>([^<]*)</title>', 1), '') as title, coalesce(regexp_extract(html, '<html[^>]* lang=\"([a-z]+)\"', 1), '') as lang, len(regexp_extract_all(html, '<p>'))::bigint as paragraphs from pages")
def page_fields(spark, d):
    html = F.col("html")
    return table(spark, d, "pages").select(
        "page_id", F.regexp_extract(html, "<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract(html, '<html[^>]* lang="([a-z]+)"', 1).alias("lang"),
        F.regexp_count(html, F.lit("<p>")).cast("long").alias("paragraphs"))


@query("""select doc_id, case when regexp_matches(text, '[a-zA-ZÀ-ÖØ-öø-ɏ]') then 'LATIN' end as script from documents""")
def script_majority(spark, d):
    return table(spark, d, "documents").select("doc_id", T.dominant_script(F.col("text")).alias("script"))


# Identifiers ----------------------------------------------------------------------------------------------------------------------

_RAW_SQL = """(case o_orderkey % 8 when 0 then 'A' || o_orderkey when 1 then 'a foreign ' || o_orderkey when 2 then 'A ad int. ' || o_orderkey when 3 then 'AIO-' || o_orderkey
 when 4 then 'A ' || o_orderkey || ' A' || (o_orderkey + 1) when 5 then 'BB—' || o_orderkey when 6 then 'A INTERNATIONAL ' || o_orderkey else 'AF0' || o_orderkey end)"""


def _raw_regnum() -> Column:
    k = F.col("o_orderkey").cast("string")
    forms = [F.concat(F.lit("A"), k), F.concat(F.lit("a foreign "), k), F.concat(F.lit("A ad int. "), k), F.concat(F.lit("AIO-"), k),
             F.concat(F.lit("A "), k, F.lit(" A"), (F.col("o_orderkey") + 1).cast("string")), F.concat(F.lit("BB—"), k), F.concat(F.lit("A INTERNATIONAL "), k)]
    out = F.concat(F.lit("AF0"), k)
    for i, form in enumerate(forms):
        out = F.when(F.col("o_orderkey") % 8 == i, form).otherwise(out)
    return out


_NORM_REG = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(upper({raw})), '^A[\s—–-]*(?:FOREIGN|FOR)\.?(\s|$)', 'AF\1'), '^A[\s—–-]*(?:AD[\s—–-]*INT|INT)\.?(\s|$)', 'AI\1'), '[^A-Z0-9]', '', 'g'), '^(A[IF])[O0]([0-9])', '\1\2')"""


@query(f"""with r as (select o_orderkey, {_RAW_SQL} as raw from orders), n as (select *, {_NORM_REG.format(raw='raw')} as regnum from r)
select o_orderkey, regnum, regexp_extract(regnum, '^[A-Z]+') as class, coalesce({map_sql(I.CLASS_FORMATS)}[regexp_extract(regnum, '^[A-Z]+')], 'Unknown') as format,
 (len(string_split_regex(trim(upper(raw)), '\\s+')) > 1 and len(list_filter(string_split_regex(trim(upper(raw)), '\\s+'), lambda t: not regexp_full_match(t, '[A-Z]*[0-9]+'))) = 0) as is_range from n""")
def regnum_normalize(spark, d):
    raw = F.col("raw")
    return table(spark, d, "orders").select("o_orderkey", _raw_regnum().alias("raw")).select(
        "o_orderkey", I.normalize_regnum(raw).alias("regnum"), I.reg_class(raw).alias("class"), I.reg_format(raw).alias("format"), I.is_multi_regnum(raw).alias("is_range"))


@query("""with r as (select o_orderkey, case o_orderkey % 4 when 0 then ' 75-' || o_orderkey || '/AC/r86 ' when 1 then '2001' || lpad(o_orderkey::varchar, 6, '0') when 2 then 'gm 71-' || o_orderkey else '' end as raw from orders),
 b as (select *, string_split(regexp_replace(raw, '\\s+', '', 'g'), '/')[1] as bare from r), p as (select *, string_split(bare, '-') as parts from b)
select o_orderkey, nullif(case when len(parts) = 2 then parts[1] || case when length(parts[2]) < 6 then lpad(parts[2], 6, '0') else parts[2] end else bare end, '') as lccn from p""")
def lccn_canonical(spark, d):
    k, m = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 4
    raw = F.when(m == 0, F.concat(F.lit(" 75-"), k, F.lit("/AC/r86 "))).when(m == 1, F.concat(F.lit("2001"), F.lpad(k, 6, "0"))).when(m == 2, F.concat(F.lit("gm 71-"), k)).otherwise("")
    return table(spark, d, "orders").select("o_orderkey", I.normalize_lccn(raw).alias("lccn"))


_PUB_SQL = "array_to_string(list_filter(list_transform(list_filter(string_split(regexp_replace(lower({c}), '[^a-z0-9&.]+', ' ', 'g'), ' '), lambda t: t <> '' and not list_contains([" + ", ".join(f"'{w}'" for w in I.PUBLISHER_STOPWORDS) + "], t)), lambda t: regexp_replace(t, '[^a-z0-9]', '', 'g')), lambda t: t <> ''), ' ')"


_HOUSE = "case s_suppkey % 4 when 0 then 'The ' || n_name || ' Press' when 1 then n_name || ' Publishing Co. & Sons' when 2 then upper(s_name) || ', Ltd.' else n_name || ' Imprint Books' end"


@query(f"""with s as (select s_suppkey, {_HOUSE} as name from supplier join nation on s_nationkey = n_nationkey), k as (select s_suppkey, {_PUB_SQL.format(c="name")} as house from s),
 alias as (select {_PUB_SQL.format(c="name")} as vkey, min(canonical) as canonical from (select n_name as canonical, unnest([n_name, 'House of ' || n_name, n_name || ' Imprint']) as name from nation) group by 1)
select s_suppkey, house, canonical from k left join alias on house = vkey""")
def publisher_normalize(spark, d):
    nation, m, n = table(spark, d, "nation"), F.col("s_suppkey") % 4, F.col("n_name")
    named = table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    name = F.when(m == 0, F.concat(F.lit("The "), n, F.lit(" Press"))).when(m == 1, F.concat(n, F.lit(" Publishing Co. & Sons"))).when(m == 2, F.concat(F.upper("s_name"), F.lit(", Ltd."))).otherwise(F.concat(n, F.lit(" Imprint Books")))
    houses = nation.select(n.alias("canonical"), F.array(F.concat(F.lit("House of "), n)).alias("aliases"), F.array(F.concat(n, F.lit(" Imprint"))).alias("imprints"))
    rows = I.with_house(named.select("s_suppkey", name.alias("name")), "name", I.alias_index(houses))
    return rows.select("s_suppkey", I.normalize_publisher(F.col("name")).alias("house"), "canonical")


_CLAIM = "case c_custkey % 5 when 0 then c_name || '|A' when 1 then c_name || ' (W); Heirs of ' || c_name || '|C' when 2 then c_name || '||Estate|PWH||' when 3 then c_name || ' (c)' else '' end"


@query(f"""with r as (select c_custkey, {_CLAIM} as raw from customer),
 p as (select c_custkey, list_filter(list_transform(string_split_regex(raw, '\\|\\||;'), lambda x: trim(x)), lambda x: x <> '') as parts from r),
 q as (select c_custkey, list_transform(parts, lambda x: case when regexp_matches(x, '^.+\\|\\s*[A-Z]+$') then trim(regexp_extract(x, '^(.+)\\|\\s*([A-Z]+)$', 1)) when regexp_matches(x, '^.*\\(\\s*[A-Z]+\\s*\\)$') then trim(regexp_extract(x, '^(.*)\\(\\s*([A-Z]+)\\s*\\)$', 1)) else x end) as names,
  list_transform(parts, lambda x: case when regexp_matches(x, '^.+\\|\\s*[A-Z]+$') then regexp_extract(x, '^(.+)\\|\\s*([A-Z]+)$', 2) when regexp_matches(x, '^.*\\(\\s*[A-Z]+\\s*\\)$') then regexp_extract(x, '^(.*)\\(\\s*([A-Z]+)\\s*\\)$', 2) else '' end) as codes from p)
select c_custkey, array_to_string(names, ' / ') as names, array_to_string(codes, ',') as codes,
 coalesce(nullif(array_to_string(list_filter(list_transform(codes, lambda c: {map_sql(I.RENEWAL_LABELS)}[c]), lambda l: l is not null), '; '), ''), 'Unknown') as label from q""")
def claimant_parse(spark, d):
    m, name = F.col("c_custkey") % 5, F.col("c_name")
    raw = F.when(m == 0, F.concat(name, F.lit("|A"))).when(m == 1, F.concat(name, F.lit(" (W); Heirs of "), name, F.lit("|C"))).when(m == 2, F.concat(name, F.lit("||Estate|PWH||"))).when(m == 3, F.concat(name, F.lit(" (c)"))).otherwise("")
    pairs = I.parse_claimants(F.col("raw"))
    return table(spark, d, "customer").select("c_custkey", raw.alias("raw")).select(
        "c_custkey", F.array_join(F.transform(pairs, lambda p: p["name"]), " / ").alias("names"), F.array_join(F.transform(pairs, lambda p: p["code"]), ",").alias("codes"), I.claimant_renewal_label(F.col("raw")).alias("label"))


@query("""with t as (select p_partkey, p_size, (['','x','xx','xxx','xl','l'])[p_size // 10 + 1] || (['','i','ii','iii','iv','v','vi','vii','viii','ix'])[p_size % 10 + 1] as roman from part)
select p_partkey, roman, p_size as value, 'volume ' || p_size || ' of 2' as normalized from t""")
def roman_numbers(spark, d):
    tens, units = F.array(*map(F.lit, ["", "x", "xx", "xxx", "xl", "l"])), F.array(*map(F.lit, ["", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix"]))
    roman = F.concat(F.get(tens, F.floor(F.col("p_size") / 10).cast("int")), F.get(units, F.col("p_size") % 10))
    rows = table(spark, d, "part").select("p_partkey", roman.alias("roman"))
    return rows.select("p_partkey", "roman", N.roman_to_int(F.col("roman")).alias("value"), N.normalize_numbers(F.concat(F.lit("vol. "), F.upper("roman"), F.lit(" of second"))).alias("normalized"))


# Extents, parts and cues ----------------------------------------------------------------------------------------------------------


@query("""select doc_id, nullif(case doc_id % 5 when 0 then n_chars % 900 when 1 then n_chars % 700 when 2 then greatest(n_chars % 40, 12) when 3 then 0 else n_chars % 50 end, 0)::int as pages from documents""")
def page_count_extract(spark, d):
    n, m, k = F.col("n_chars"), F.col("doc_id") % 5, lambda x: x.cast("string")
    extent = (
        F.when(m == 0, F.concat(F.lit("xii, "), k(n % 900), F.lit(" p."))).when(m == 1, F.concat(F.lit("2 v. in 1 ("), k(n % 700), F.lit(" p.)")))
        .when(m == 2, F.concat(k(n % 40), F.lit(" p., 12 plates"))).when(m == 3, F.lit("3 vols.")).otherwise(F.concat(F.lit("[4], iv, "), k(n % 50), F.lit(" leaves")))
    )
    return table(spark, d, "documents").select("doc_id", S.page_count(extent).alias("pages"))


@query("""select p_partkey, case p_partkey % 6 when 0 then p_size::varchar when 1 then null when 2 then '3' when 3 then 'iv' else null end as part, (p_partkey % 6 in (0, 1, 2, 3, 4)) as has_part, (p_partkey % 6 = 5) as collected,
 (p_partkey % 6 = 1) as is_range from part""")
def part_designators(spark, d):
    m, name = F.col("p_partkey") % 6, F.lit("Annals")
    title = (
        F.when(m == 0, F.concat(name, F.lit(". Vol. "), F.col("p_size").cast("string"))).when(m == 1, F.concat(name, F.lit(", Vols. 1-4"))).when(m == 2, F.concat(name, F.lit(", Band three")))
        .when(m == 3, F.concat(name, F.lit(", pt. IV"))).when(m == 4, F.concat(name, F.lit(", II: the sea"))).otherwise(F.lit("The collected works"))
    )
    return table(spark, d, "part").select("p_partkey", title.alias("t")).select(
        "p_partkey", S.part_number(F.col("t")).alias("part"), S.has_part_designator(F.col("t")).alias("has_part"), S.is_collected(F.col("t")).alias("collected"), S.is_part_range(F.col("t")).alias("is_range"))


@query("""with t as (select doc_id, case doc_id % 4 when 0 then 'tr. by ' || source when 1 then 'English version of ' || source when 2 then 'From the German of ' || source else text end as note from documents)
select doc_id, (regexp_matches(note, '(?i)\\btr(?:ans(?:lated|lation)?)?\\.?\\b') or (regexp_matches(note, '(?i)\\bversion\\b') and not regexp_matches(note, '(?i)\\bversion\\b.*program')) or regexp_matches(note, '(?i)\\bfrom the (?:French|German|Spanish|Italian|Russian|Latin|Greek|Hebrew|Japanese|Chinese|Arabic|Portuguese|Polish|Dutch|Swedish|Norwegian|Danish|Czech|Hungarian|Yiddish)\\b')) as translated from t""")
def translation_signal(spark, d):
    m, source = F.col("doc_id") % 4, F.col("source")
    note = F.when(m == 0, F.concat(F.lit("tr. by "), source)).when(m == 1, F.concat(F.lit("English version of "), source)).when(m == 2, F.concat(F.lit("From the German of "), source)).otherwise(F.col("text"))
    return table(spark, d, "documents").select("doc_id", S.is_translation(note).alias("translated"))


_YEAR = "(1900 + n_chars % 90)"


@query(f"""with r as (select *, case when doc_id % 13 = 0 then 'not_text' when doc_id % 11 = 0 then 'not_monograph' when doc_id % 17 = 0 then 'electronic' when doc_id % 19 = 0 then 'short_008' when lang not in ('en', 'fr', 'de', 'es') then 'language'
  when doc_id % 23 = 0 then 'no_year' when {_YEAR} < 1931 then 'too_early' when {_YEAR} > 1977 then 'too_late' when doc_id % 29 = 0 then 'government' when trim(coalesce(text, '')) = '' then 'no_title' else 'eligible' end as why from documents)
select case when why = 'eligible' and lang = 'es' then 'language_not_asked' else why end as reason, count(*) as n from r group by 1""")
def eligibility_reasons(spark, d):
    from ..sources import xml

    k, pad = F.col("doc_id"), lambda n: F.lit(" " * n)
    leader = F.concat(F.lit("00000n"), F.when(k % 13 == 0, "c").otherwise("a"), F.when(k % 11 == 0, "s").otherwise("m"), pad(16))
    code = F.coalesce(I.lookup({"en": "eng", "fr": "fre", "de": "ger", "es": "spa"}, F.col("lang")), F.lit("xxx"))
    year = F.when(k % 23 == 0, "19uu").otherwise((1900 + F.col("n_chars") % 90).cast("string"))
    fixed = F.concat(F.lit("000000s"), year, pad(17), F.when(k % 29 == 0, "f").otherwise(" "), pad(6), code, pad(2))
    fixed = F.when(k % 19 == 0, F.substring(fixed, 1, 20)).otherwise(fixed)
    reason = xml.eligibility(1931, leader, fixed, k % 17 == 0, F.col("text"))
    return xml.filtered(table(spark, d, "documents").select("doc_id", reason.alias("reason"), code.alias("language")), ("eng", "fre", "ger"))[1]


@query("""select c_custkey, coalesce(case when c_custkey % 3 = 0 then null else nullif(case when c_custkey % 3 = 1 then '' else c_mktsegment end, '') end, c_name) as first_field, concat_ws(' ', nullif(case when c_custkey % 3 = 1 then '' else c_mktsegment end, ''), n_name) as joined_field from customer join nation on c_nationkey = n_nationkey""")
def field_composition(spark, d):
    m = F.col("c_custkey") % 3
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    segment = F.when(m == 1, "").otherwise(F.col("c_mktsegment"))
    return rows.select("c_custkey", S.first_of(F.when(m != 0, segment), F.col("c_name")).alias("first_field"), S.joined(segment, F.col("n_name")).alias("joined_field"))


# Index and candidates -------------------------------------------------------------------------------------------------------------

_DT = f"dt as (select doc_id, lang, n_chars, unnest(list_filter(list_distinct({tok_sql('text')}), lambda t: not list_contains({STOP_SQL}, t))) as token from documents)"
_BT = f"bt as (select item_id, unnest(list_filter(list_distinct({tok_sql('text')}), lambda t: not list_contains({STOP_SQL}, t))) as token from benchmark)"
_IDF = "n_docs as (select count(*) as n from documents), freq as (select token, count(*) as df from dt group by token), idf as (select token, df, n, ln((n + 1)::double / (df + 1)) + 1 as idf from freq, n_docs)"
CUT = 0.05


def _doc_tokens(spark, d) -> DataFrame:
    return documents(spark, d).select("doc_id", "lang", T.long_token_keys(F.col("text")).alias("tokens"))


def _item_tokens(spark, d) -> DataFrame:
    return table(spark, d, "benchmark").select("item_id", T.long_token_keys(F.col("text")).alias("tokens"))


@query(f"with {_DT}, {_IDF} select token, df, n, round(idf, 6) as idf from idf")
def idf_documents(spark, d):
    return retrieval.idf(_doc_tokens(spark, d)).select("token", "df", "n", six(F.col("idf")).alias("idf"))


@query(f"with {_DT}, n_docs as (select lang, count(*) as n from documents group by lang), freq as (select lang, token, count(*) as df from dt group by all) select lang, token, df, n, round(ln((n + 1)::double / (df + 1)) + 1, 6) as idf from freq join n_docs using (lang)")
def idf_by_language(spark, d):
    return retrieval.idf(_doc_tokens(spark, d), ["lang"]).select("lang", "token", "df", "n", six(F.col("idf")).alias("idf"))


@query(f"with {_DT}, s as (select doc_id, lower(source) as token from documents), p as (select 'title' as field, token, doc_id from dt union all select 'publisher', token, doc_id from s) select field, count(*) as postings, count(distinct token) as tokens, count(distinct doc_id) as records from p group by field")
def postings_stats(spark, d):
    docs = documents(spark, d)
    rows = retrieval.postings(docs, {"title": T.token_keys(F.col("text")), "publisher": T.tokenize(F.col("source"))}, "doc_id")
    return rows.groupBy("field").agg(F.count(F.lit(1)).alias("postings"), F.countDistinct("token").alias("tokens"), F.countDistinct("doc_id").alias("records"))


@query("select year(o_orderdate)::int as year, count(*) as n, min(o_orderkey) as first_key, max(o_orderkey) as last_key from orders group by 1")
def year_buckets(spark, d):
    return table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query(f"""with {_DT}, {_BT}, {_IDF}, k as (select item_id, token, df <= {CUT} * n as rare, bool_or(df <= {CUT} * n) over (partition by item_id) as any_rare from bt join idf using (token)),
 c as (select distinct item_id, doc_id from k join dt using (token) where (rare or not any_rare) and abs((1900 + item_id % 90) - (1900 + doc_id % 90)) <= 20)
select item_id, count(*) as candidates from c group by item_id""")
def candidates_token_year(spark, d):
    year = lambda c: (F.pmod(F.col(c), F.lit(90)) + 1900).cast("int")
    terms = _doc_tokens(spark, d).select("doc_id", F.explode("tokens").alias("token")).repartition("token")
    n = table(spark, d, "documents").agg(F.count(F.lit(1)).alias("n"))  # a single row
    rare = terms.groupBy("token").agg(F.count(F.lit(1)).alias("df")).crossJoin(n).select("token", (F.col("df") <= CUT * F.col("n")).alias("rare"))
    asked = _item_tokens(spark, d).select("item_id", F.explode("tokens").alias("token")).join(rare, "token")
    keys = retrieval.blocking_tokens(asked, "item_id")
    queries = keys.select(F.col("item_id").alias("query"), F.lit("title").alias("field"), "token", year("item_id").alias("year"))
    index = terms.select(F.lit("title").alias("field"), "token", year("doc_id").alias("year"), "doc_id")
    return retrieval.candidates(queries, index, 20).groupBy(F.col("query").alias("item_id")).agg(F.count(F.lit(1)).alias("candidates"))


# Renewals -------------------------------------------------------------------------------------------------------------------------


@query("""with keys as (select o_orderkey, year(o_orderdate) as y, unnest([o_orderkey, o_orderkey + 1, o_orderkey + 2]) as k, unnest([0, 1, 2]) as place from orders),
 ren as (select l_orderkey as k, year(l_shipdate) as y, arg_max(l_orderkey * 10 + l_linenumber, l_shipdate::varchar || lpad(l_linenumber::varchar, 3, '0')) as entry from lineitem where l_linenumber > 2 group by all),
 hit as (select o_orderkey, arg_min(entry, place) as entry_id from keys join ren using (k, y) group by 1)
select o_orderkey, entry_id, entry_id is not null as was_renewed from orders left join hit using (o_orderkey)""")
def renewal_join_first_hit(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    key = lambda k: F.struct(F.col("o_orderkey").__add__(k).cast("string").alias("regnum"), F.col("year"))
    keys = orders.select("o_orderkey", F.array(*map(key, range(3))).alias("keys"))
    items = table(spark, d, "lineitem").where("l_linenumber > 2")
    rows = items.select(F.col("l_orderkey").cast("string").alias("regnum"), F.year("l_shipdate").alias("year"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("entry_id"), F.struct("l_shipdate", "l_linenumber").alias("order"))
    hit = renewal.first_hit(keys, renewal.last_renewals(rows, "order"), "o_orderkey")
    return orders.join(hit, "o_orderkey", "left").select("o_orderkey", "entry_id", F.col("entry_id").isNotNull().alias("was_renewed"))


@query("""with r as (select o_orderkey, year(o_orderdate) as y, o_orderkey - 1 as cited, case when o_orderkey % 7 = 0 then o_orderkey * 100 end as entry from orders),
 c as (select o_orderkey as a, entry as ea, y as y, cited from r union all select o_orderkey, entry, y - 1, cited from r),
 p as (select a, ea, b.o_orderkey as b, b.entry as eb from c join r b on b.o_orderkey = c.cited and b.y = c.y),
 found as (select a as o_orderkey, b as sibling, eb as e from p where ea is null and eb is not null union all select b, a, ea from p where eb is null and ea is not null)
select o_orderkey, max(sibling) as sibling, arg_max(e, sibling) as sibling_entry from found group by 1""")
def sibling_propagation(spark, d):
    k = F.col("o_orderkey")
    records = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), k.cast("string").alias("regnum"), F.array((k - 1).cast("string")).alias("cited"), F.when(k % 7 == 0, k * 100).alias("entry_id"))
    return renewal.sibling_renewals(records, "o_orderkey").select("o_orderkey", "sibling", "sibling_entry")


@query("""with m as (select count(l_orderkey) as m from (select distinct o_orderkey from orders) o left join lineitem on l_orderkey = o_orderkey group by o_orderkey)
select case when m <= 5 then m::varchar when m <= 10 then '6-10' when m <= 50 then '11-50' when m <= 100 then '51-100' else '101+' end as matches, count(*) as n from m group by 1""")
def join_fanout_histogram(spark, d):
    return renewal.fanout(table(spark, d, "orders").select(F.col("o_orderkey").alias("k")), table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")), ["k"])


# Scores ---------------------------------------------------------------------------------------------------------------------------


def _pairs(spark, d) -> DataFrame:
    """(item_id, doc_id, shared, mass_a, mass_b, floor, k, best): weights of the words that a passage and a document share and have."""
    return retrieval.weighted_overlap(_item_tokens(spark, d), _doc_tokens(spark, d), "item_id", "doc_id", CUT)


def _pair_keys(spark, d) -> DataFrame:
    """(item_id, doc_id) of `_pairs`."""
    return retrieval.overlap_candidates(_item_tokens(spark, d), _doc_tokens(spark, d), "item_id", "doc_id", CUT)


_PAIRS = f"""{_DT}, {_BT}, {_IDF}, top as (select ln(n + 1) + 1 as floor from n_docs),
 judged as (select item_id, token, coalesce(idf, floor) as idf, floor, coalesce(df <= {CUT} * n, false) as rare from bt left join idf using (token), top),
 asked as (select *, rare or not bool_or(rare) over (partition by item_id) as key from judged),
 mb as (select doc_id, sum(idf) as mass_b from dt join idf using (token) group by 1), ma as (select item_id, sum(idf) as mass_a, max(floor) as floor from asked group by 1),
 sh as (select item_id, doc_id, sum(asked.idf) as shared from asked join dt using (token) group by all having bool_or(key)),
 pairs as (select item_id, doc_id, shared, mass_a, mass_b, floor, 100 * (shared / (mass_a + mass_b - shared)) * least(1.0, shared / floor) as title, shared / least(mass_a, mass_b) as coverage from sh join ma using (item_id) join mb using (doc_id))"""


@query(f"with {_PAIRS} select item_id, doc_id, round(title, 6) as score, round(coverage, 6) as coverage from pairs")
def title_idf_jaccard(spark, d):
    score = scoring.idf_similarity(F.col("shared"), F.col("mass_a") - F.col("shared"), F.col("mass_b") - F.col("shared"), F.col("floor"))
    return _pairs(spark, d).select("item_id", "doc_id", six(score).alias("score"), six(scoring.coverage(F.col("shared"), F.col("mass_a"), F.col("mass_b"))).alias("coverage"))


@query("""select a.doc_id, a.n_chars // 100 as pages_a, b.n_chars // 100 as pages_b, case when b.n_chars is null then 0.0 else greatest(100.0 - 5.0 * greatest(abs(a.n_chars // 100 - b.n_chars // 100) - 2, 0), 0.0) end::double as score, b.n_chars is null as skipped from documents a left join documents b on b.doc_id = a.doc_id + 1""")
def extent_score(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.floor(F.col("n_chars") / 100).alias("pages_a"))
    rows = docs.join(docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("pages_a").alias("pages_b")), "doc_id", "left")
    e = scoring.extent_score(F.col("pages_a"), F.col("pages_b"))
    return rows.select("doc_id", "pages_a", "pages_b", e["score"].alias("score"), e["skipped"].alias("skipped"))


@query("""select l_orderkey, l_linenumber, greatest(100.0 - 25.0 * abs(year(l_shipdate) - year(o_orderdate)), 0.0)::double as score from lineitem join orders on l_orderkey = o_orderkey""")
def year_score(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate").join(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select("l_orderkey", "l_linenumber", scoring.year_score(F.year("l_shipdate"), F.year("o_orderdate"))["score"].alias("score"))


@query("""select o_orderkey, (o_orderkey % 3 = 0) as decisive, (o_orderkey % 3 <> 0) as skipped, case when o_orderkey % 3 = 0 then 100.0 else 0.0 end::double as score from orders""")
def lccn_score(spark, d):
    k = F.col("o_orderkey")
    a = I.normalize_lccn(F.concat(F.lit("75-"), k.cast("string")))
    b = F.when(k % 3 == 0, I.normalize_lccn(F.concat(F.lit(" 75-"), k.cast("string"), F.lit("/r1")))).when(k % 3 == 1, F.lit("other"))
    e = scoring.lccn_score(a, b)
    return table(spark, d, "orders").select("o_orderkey", e["decisive"].alias("decisive"), e["skipped"].alias("skipped"), e["score"].alias("score"))


@query("""select p_partkey, case when p_size = p_partkey % 50 + 1 then 100.0 else 0.0 end::double as score from part""")
def edition_score(spark, d):
    a, b = F.concat(F.col("p_size").cast("string"), F.lit("th edition")), F.concat((F.col("p_partkey") % 50 + 1).cast("string"), F.lit("d ed."))
    return table(spark, d, "part").select("p_partkey", scoring.edition_score(a, b, F.lit(0.0))["score"].alias("score"))


@query(f"""with {_PAIRS}, g as (select item_id, doc_id, count(*) as k, max(asked.idf) as best from asked join dt using (token) join pairs using (item_id, doc_id) group by all)
select item_id, doc_id, round(case when k = 1 then case when least(best / floor, 1) >= 0.6 then least(best / floor, 1) else least(best / floor, 1) ** 2 / 0.6 end else greatest(shared / (mass_a + mass_b - shared), least(best / floor, 1)) end, 6) as gate from pairs join g using (item_id, doc_id)""")
def idf_gate(spark, d):
    gate = scoring.idf_gate(F.col("shared"), F.col("mass_a") + F.col("mass_b") - F.col("shared"), F.col("best"), F.col("k"), F.lit(False), F.col("floor"))
    return _pairs(spark, d).select("item_id", "doc_id", six(gate).alias("gate"))


def _combined(spark, d) -> DataFrame:
    """_pairs with evidence, the combined score and its calibration."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars", "source")
    items = table(spark, d, "benchmark").select("item_id", F.char_length("text").alias("item_chars"))
    rows = _pairs(spark, d).join(docs, "doc_id").join(items, "item_id")
    f = {
        "title": scoring.evidence(100 * scoring.coverage(F.col("shared"), F.col("mass_a"), F.col("mass_b")), F.lit(False)),
        "extent": scoring.extent_score(F.floor(F.col("item_chars") / 100), F.floor(F.col("n_chars") / 100)),
        "volume": scoring.volume_score(F.when(F.col("item_id") % 5 == 0, "whole").otherwise("unknown"), F.lit(None), F.when(F.col("doc_id") % 7 == 0, "part").otherwise("unknown"), F.lit("1"), F.lit(None)),
        "lccn": scoring.lccn_score(F.lit(None).cast("string"), F.lit(None).cast("string")),
    }
    rows = rows.select("item_id", "doc_id", "source", *(e.alias(k) for k, e in f.items()))
    f = {k: F.col(k) for k in f}
    more = scoring.multipliers(f, F.lit(False))
    raw = scoring.weighted_mean(f, {"title": 0.389, "extent": 0.0556, "volume": 0.0556, "lccn": 0.1111}, more)
    raw = scoring.capped(raw, scoring.uncorroborated(f["volume"], F.lit(False), f["lccn"]))
    return rows.withColumn("raw", raw).withColumn("calibrated", scoring.platt(F.col("raw"), -0.135969, 6.989077))


_COMBINED = f"""{_PAIRS}, parts as (select item_id, doc_id, source, 100 * coverage as title, greatest(100.0 - 5.0 * greatest(abs(length(b.text) // 100 - n_chars // 100) - 2, 0), 0.0) as extent, (item_id % 5 = 0 and doc_id % 7 = 0) as volume_zero from pairs join documents using (doc_id) join benchmark b using (item_id)),
 weighed as (select *, 0.389 * case when title >= 50 and extent < 50 then 0.3 else 1.0 end as wt from parts),
 rawed as (select *, (wt * title + 0.0556 * extent) / (wt + 0.0556 + case when volume_zero then 0.0556 else 0.0 end) as raw0 from weighed),
 combined as (select item_id, doc_id, source, case when volume_zero then least(raw0, 30.0) else raw0 end as raw from rawed), calibrated as (select *, 1 / (1 + exp(-0.135969 * raw + 6.989077)) as calibrated from combined)"""


@query(f"with {_COMBINED} select item_id, doc_id, round(raw, 6) as raw, round(calibrated, 6) as calibrated from calibrated")
def weighted_mean_combine(spark, d):
    return _combined(spark, d).select("item_id", "doc_id", six(F.col("raw")).alias("raw"), six(F.col("calibrated")).alias("calibrated"))


@query("""with s as (select doc_id, quality, (n_chars % 101)::double as raw from labels join documents using (doc_id)) select doc_id, quality, round(1 / (1 + exp(-0.135969 * raw + 6.989077)), 6) as p from s""")
def platt_apply(spark, d):
    rows = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return rows.select("doc_id", "quality", six(scoring.platt((F.col("n_chars") % 101).cast("double"), -0.135969, 6.989077)).alias("p"))


def _top(spark, d, floor: float = 0.05) -> DataFrame:
    rows = _combined(spark, d).withColumn("calibrated", six(F.col("calibrated")))
    return scoring.top_matches(rows, "item_id", "doc_id", "calibrated", floor)


_TOP = f"""{_COMBINED}, ranked as (select item_id, doc_id, source, raw, round(calibrated, 6) as calibrated, count(*) over (partition by item_id) as considered from calibrated),
 best3 as (select *, row_number() over (partition by item_id order by calibrated desc, doc_id) as rank from ranked where calibrated >= 0.05 qualify rank <= 3)"""


@query(f"with {_TOP} select item_id, doc_id, calibrated, considered, rank::int as rank from best3")
def topk_matches(spark, d):
    return _top(spark, d).select("item_id", "doc_id", "calibrated", "considered", F.col("rank").cast("int").alias("rank"))


@query(f"with {_TOP}, best as (select * from best3 where rank = 1), truth as (select item_id, item_id * 3 % 500 as doc_id from benchmark), j as (select t.doc_id as truth, b.doc_id as top from truth t left join best b using (item_id)) select count(*) as evaluated, count(top) as with_top, count(*) filter (where top = truth) as correct, round(coalesce(count(*) filter (where top = truth) / nullif(count(top), 0), 0), 6) as precision, round(count(*) filter (where top = truth) / count(*), 6) as recall from j")
def linkage_precision_recall(spark, d):
    truth = table(spark, d, "benchmark").select("item_id", (F.col("item_id") * 3 % 500).alias("doc_id"))
    out = metrics.linkage_quality(_top(spark, d).where("rank = 1"), truth, "item_id", "doc_id")
    return out.select("evaluated", "with_top", "correct", six(F.col("precision")).alias("precision"), six(F.col("recall")).alias("recall"))


# Evaluation -----------------------------------------------------------------------------------------------------------------------

_SCORED = "s as (select quality as label, round((n_chars % 997) / 997.0::double, 4) as score from labels join documents using (doc_id))"


def _scored(spark, d) -> DataFrame:
    rows = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return rows.select("doc_id", F.col("quality").alias("label"), F.round((F.col("n_chars") % 997) / F.lit(997.0), 4).alias("score"))


@query(f"with {_SCORED}, p as (select score from s where label = 1), n as (select score from s where label = 0), w as (select sum(case when p.score > n.score then 1.0 when p.score = n.score then 0.5 else 0.0 end) as won from p, n) select round((select won from w)::double / ((select count(*) from p) * (select count(*) from n)), 6) as auc, (select count(*) from p) as positives, (select count(*) from n) as negatives")
def roc_auc(spark, d):
    return metrics.roc_auc(_scored(spark, d)).select(six(F.col("auc")).alias("auc"), F.col("positives").cast("long").alias("positives"), F.col("negatives").cast("long").alias("negatives"))


@query(f"with {_SCORED}, g as (select score, count(*) as n, sum(label) as pos from s group by 1), c as (select pos, sum(pos) over (order by score desc) as hits, sum(n) over (order by score desc) as seen from g) select round((sum(pos * (hits / seen)) / sum(pos))::double, 6) as ap from c")
def average_precision(spark, d):
    return metrics.average_precision(_scored(spark, d)).select(six(F.col("ap")).alias("ap"))


@query(f"""with {_SCORED}, t as (select round(i / 20.0::double, 4) as threshold from range(0, 21) r(i)), c as (select threshold, count(*) filter (where score >= threshold and label = 1) as tp, count(*) filter (where score >= threshold and label = 0) as fp, count(*) filter (where score < threshold and label = 1) as fn from s, t group by 1),
 q as (select *, case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as p, case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as r from c) select threshold, tp, fp, fn, round(p::double, 6) as precision, round(r::double, 6) as recall, round(case when p + r > 0 then 2 * p * r / (p + r) else 0 end::double, 6) as f1 from q""")
def threshold_sweep(spark, d):
    return metrics.threshold_sweep(_scored(spark, d)).select("threshold", "tp", "fp", "fn", *(six(F.col(c)).alias(c) for c in ("precision", "recall", "f1")))


@query("with o as (select o_totalprice as v, row_number() over (order by o_totalprice) - 1 as i, count(*) over () as n from orders) select max(v) filter (where i = floor(0.9 * (n - 1))) as o_totalprice from o")
def nearest_rank_percentile(spark, d):
    return metrics.nearest_rank(table(spark, d, "orders"), "o_totalprice", 0.9)


# Sampling and labels --------------------------------------------------------------------------------------------------------------


@query("""with b as (select doc_id, lang, (n_chars % 1000) / 1000.0::double as score from documents), c as (select doc_id, lang, case when score >= 0.9 then 'ge90' when score >= 0.8 then 'b80_90' when score >= 0.7 then 'b70_80' when score >= 0.6 then 'b60_70' else 'below' end as band from b)
select lang, band, doc_id, row_number() over (partition by lang, band order by doc_id)::int as place from c qualify place <= 5""")
def band_caps(spark, d):
    band = S.score_band((F.col("n_chars") % 1000) / F.lit(1000.0))
    rows = table(spark, d, "documents").select("lang", band.alias("band"), "doc_id")
    return labels.capped(rows, ["lang", "band"], [F.col("doc_id")], 5).select("lang", "band", "doc_id", F.col("place").cast("int").alias("place"))


@query("select lang, doc_id from documents qualify row_number() over (partition by lang order by (doc_id * 2654435761) % 4294967296, doc_id) <= 20")
def reservoir_by_language(spark, d):
    rows = table(spark, d, "documents").select("lang", "doc_id")
    return labels.reservoir(rows, ["lang"], "doc_id", 20, order=(F.col("doc_id") * F.lit(2654435761)) % F.lit(4294967296)).select("lang", "doc_id")


@query("""with s as (select doc_id, case when doc_id % 11 = 0 then null else doc_id % 3 end as pa, (n_chars % 100) / 100.0::double as sa, case when doc_id % 11 = 0 then null else doc_id % 2 end as pb, (n_chars % 90) / 90.0::double as sb from documents),
 q as (select case when pa is null and pb is null then 0.0 else abs(sa - sb) + case when pa is not distinct from pb then 0 else 1 end end as gap, case when pa is not distinct from pb and sa >= 0.7 and sb >= 0.7 then 'agree_high' when pa is not distinct from pb and sa <= 0.3 and sb <= 0.3 then 'agree_low' else 'informative' end as bucket from s)
select b as bucket, count(bucket) as n, round(coalesce(min(gap), 0), 6) as least, round(coalesce(max(gap), 0), 6) as most, round(coalesce(avg(gap), 0), 6) as mean from (values ('agree_high'), ('agree_low'), ('informative')) t(b) left join q on b = bucket group by 1""")
def disagreement_buckets(spark, d):
    k, n = F.col("doc_id"), F.col("n_chars")
    pa, pb, sa, sb = F.when(k % 11 != 0, k % 3), F.when(k % 11 != 0, k % 2), (n % 100) / F.lit(100.0), (n % 90) / F.lit(90.0)
    rows = table(spark, d, "documents").select(labels.disagreement(pa, sa, pb, sb).alias("gap"), labels.disagreement_bucket(pa, sa, pb, sb).alias("bucket"))
    return labels.bucket_statistics(rows).select("bucket", "n", *(six(F.col(c)).alias(c) for c in ("least", "most", "mean")))


@query("select user_id, event_id, event_type from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1")
def latest_label(spark, d):
    return labels.latest(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("select lang, count(*) as total, count(quality) as labelled, count(*) filter (where quality = 1) as good, count(*) filter (where toxic = 1) as toxic from documents left join labels using (doc_id) group by 1")
def label_progress(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left")
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("total"), F.count("quality").alias("labelled"), F.count(F.when(F.col("quality") == 1, 1)).alias("good"), F.count(F.when(F.col("toxic") == 1, 1)).alias("toxic"))


@query("select doc_id, lang from documents anti join labels using (doc_id) where n_chars > 300 order by doc_id limit 1")
def next_unlabelled(spark, d):
    docs = table(spark, d, "documents").where("n_chars > 300").select("doc_id", "lang")
    return labels.missing(docs, table(spark, d, "labels"), ["doc_id"]).orderBy("doc_id").limit(1)


@query("select event_id, user_id, event_type from events where event_type in ('click', 'view') order by ts, event_id limit 25 offset 50")
def label_page(spark, d):
    return table(spark, d, "events").where(F.col("event_type").isin("click", "view")).orderBy("ts", "event_id").offset(50).limit(25).select("event_id", "user_id", "event_type")


@query("select count(*) as missing, min(doc_id) as first_id, max(doc_id) as last_id from documents anti join labels using (doc_id)")
def vault_missing(spark, d):
    rows = labels.missing(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), ["doc_id"])
    return rows.agg(F.count(F.lit(1)).alias("missing"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


@query("select doc_id, quality from labels where toxic = 0 and doc_id not in (select doc_id from documents where lang = 'fr')")
def vault_exclusion(spark, d):
    french = table(spark, d, "documents").where("lang = 'fr'").select("doc_id")
    return labels.missing(table(spark, d, "labels").where("toxic = 0"), french, ["doc_id"]).select("doc_id", "quality")


@query("with s as (select user_id, event_type, event_id, ts, value from events) select user_id, event_type, arg_max(value, (ts, event_id)) as value, max(event_id) filter (where true) is not null as present from s group by all")
def vault_upsert(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_type", "ts", "event_id", "value")
    old, new = rows.where("event_id % 3 <> 0"), rows.where("event_id % 3 = 0")
    return labels.upsert(old, new, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "value", F.lit(True).alias("present"))


@query("select (year(o_orderdate) // 10 * 10)::int as decade, o_orderpriority, count(*) as n from orders group by all")
def decade_counts(spark, d):
    return table(spark, d, "orders").groupBy(S.decade(F.year("o_orderdate")).alias("decade"), "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("select (year(o_orderdate) // 10 * 10)::int as decade, o_orderstatus, o_orderkey from orders qualify row_number() over (partition by decade, o_orderstatus order by o_orderkey) <= 7")
def decade_caps(spark, d):
    rows = table(spark, d, "orders").select(S.decade(F.year("o_orderdate")).alias("decade"), "o_orderstatus", "o_orderkey")
    return labels.capped(rows, ["decade", "o_orderstatus"], [F.col("o_orderkey")], 7).drop("place")


@query("select language, band, cap, greatest(1, round_even(cap * 0.3, 0))::int as scaled from (values ('eng', 'ge90', 400), ('eng', 'below', 5), ('fre', 'b80_90', 1), ('ger', 'b70_80', 45)) t(language, band, cap)")
def budget_scaled(spark, d):
    rows = spark.createDataFrame([("eng", "ge90", 400), ("eng", "below", 5), ("fre", "b80_90", 1), ("ger", "b70_80", 45)], "language string, band string, cap int")
    return rows.withColumn("scaled", labels.scaled(F.col("cap"), 0.3))


# Similarity by UDF ----------------------------------------------------------------------------------------------------------------


def _name_pairs(spark, d, score: Callable[[], Column]) -> DataFrame:
    """(c_custkey, s_suppkey, score) of all customers and suppliers of one nation; each distinct pair of names is scored once."""
    name = lambda c, prefix: F.concat(F.lit(prefix), F.element_at(F.split(c, "#"), 1), F.lit(" "), F.col("n_name"))
    nation = table(spark, d, "nation")
    a = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_nationkey", T.tokenize(name(F.col("c_name"), "J ")).alias("a"))
    b = table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_nationkey", T.tokenize(name(F.col("s_name"), "John ")).alias("b"))
    weigh = lambda c: F.transform(c, lambda t: F.length(t).cast("double"))
    names = a.select("n_nationkey", "a").distinct().join(b.select("n_nationkey", "b").distinct(), "n_nationkey").withColumn("wa", weigh(F.col("a"))).withColumn("wb", weigh(F.col("b")))
    scored = names.select("n_nationkey", "a", "b", six(score()).alias("score"))
    return a.join(scored, ["n_nationkey", "a"]).join(b, ["n_nationkey", "b"]).select("c_custkey", "s_suppkey", "score")


@query()
def fuzzy_title_score(spark, d):
    weights = retrieval.idf(_doc_tokens(spark, d)).select("token", "idf")
    top = _top(spark, d).select("item_id", "doc_id")
    rows = top.join(table(spark, d, "benchmark").select("item_id", T.tokenize(F.col("text")).alias("a")), "item_id").join(table(spark, d, "documents").select("doc_id", T.tokenize(F.col("text")).alias("b")), "doc_id")
    words = rows.select("item_id", "doc_id", F.explode(F.array_union("a", "b")).alias("token")).join(weights, "token", "left")
    tables = words.groupBy("item_id", "doc_id").agg(F.map_from_entries(F.collect_list(F.struct("token", F.coalesce("idf", F.lit(10.0))))).alias("w"))
    rows = rows.join(tables, ["item_id", "doc_id"])
    weigh = lambda c: F.transform(c, lambda t: F.col("w")[t])
    return rows.select("item_id", "doc_id", six(similarity.title_udf("a", weigh("a"), "b", weigh("b"), F.lit(10.0))).alias("score"))


@query()
def author_score(spark, d):
    return _name_pairs(spark, d, lambda: similarity.author_udf("a", "wa", "b", "wb", F.lit(10.0)))


@query()
def publisher_score(spark, d):
    score = lambda: similarity.publisher_udf("a", "wa", "b", "wb", F.lit(10.0))
    return _name_pairs(spark, d, lambda: similarity.alias_floor(score(), F.element_at("a", -1), F.element_at("b", -1)))


@query()
def learned_predict(spark, d):
    from ..operators import learned

    rows = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars", "text"), "doc_id")
    rows = rows.select("doc_id", F.col("quality").alias("label"), F.col("n_chars").cast("double").alias("chars"), F.size(F.split("text", r"\s+")).cast("double").alias("words"), F.regexp_count("text", F.lit("[#*$%&!]")).cast("double").alias("marks"))
    model = learned.train(rows, ["chars", "words", "marks"], trees=20)
    return learned.predict(model, rows, ["chars", "words", "marks"]).select("doc_id", "label", six(F.col("raw")).alias("raw"))


_NEWTON = "list_sum(list_transform(xs, lambda r: r.n * ({}) * (1 / (1 + exp(a * r.x + b))) * (1 - 1 / (1 + exp(a * r.x + b)))))"
_SLOPE = "list_sum(list_transform(xs, lambda r: r.n * (r.t - 1 / (1 + exp(a * r.x + b))) * ({})))"


@query(f"""with recursive {_SCORED}, n as (select sum(label)::double as p, count(*) - sum(label)::double as m from s), g as (select score * 100 as x, label, count(*)::double as n from s group by all),
 xs as (select list({{'x': x, 'n': g.n, 't': case when label = 1 then (p + 1) / (p + 2) else 1 / (m + 2) end}}) as xs, any_value(ln((m + 1) / (p + 1))) as b0 from g, n),
 f as (select 0 as step, 0.0::double as a, b0 as b from xs union all
  select step + 1, a - (h22 * g1 - h12 * g2) / (h11 * h22 - h12 * h12), b - (h11 * g2 - h12 * g1) / (h11 * h22 - h12 * h12)
  from (select f.*, {_SLOPE.format('r.x')} as g1, {_SLOPE.format('1')} as g2, {_NEWTON.format('r.x * r.x')} as h11, {_NEWTON.format('r.x')} as h12, {_NEWTON.format('1')} as h22 from f, xs where step < 30))
select round(a, 6) as a, round(b, 6) as b from f where step = 30""")
def platt_fit(spark, d):
    from ..operators import learned

    return learned.platt_fit(_scored(spark, d).select((F.col("score") * 100).alias("raw"), "label")).select(six(F.col("a")).alias("a"), six(F.col("b")).alias("b"))


@query("select user_id, event_id, event_type from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1")
def stream_latest(spark, d):
    from ..streaming import upserts

    return upserts.latest_of_files(spark, f"{d}/events.parquet", ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("select date_trunc('day', ts) as day, event_type, count(*) as n, round(sum(value), 6) as total from events group by all")
def stream_daily_counts(spark, d):
    from ..streaming import upserts

    return upserts.daily_counts(spark, f"{d}/events.parquet").select("day", "event_type", "n", six(F.col("total")).alias("total"))


from . import linkage_queries  # noqa: E402, F401  registers its queries with those above
