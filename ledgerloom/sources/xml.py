"""Catalogue records and registrations from XML, with explicit schemas so that no sample decides between one and many."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identifiers
from ..functions.text import clean_text

_SUBFIELD = "struct<_code:string,_VALUE:string>"
MARC_SCHEMA = (
    "leader string, controlfield array<struct<_tag:string,_VALUE:string>>, "
    f"datafield array<struct<_tag:string,_ind1:string,_ind2:string,subfield:array<{_SUBFIELD}>>>"
)
_DATED = "struct<_date:string,_VALUE:string>"
REGISTRATION_SCHEMA = (
    "_id string, _regnum string, title string, edition string, desc string, copies string, note array<string>, "
    "lccn struct<_normalized:string,_VALUE:string>, newMatterClaimed string, regNum string, "
    "author array<struct<_claimant:string,authorName:string,authorPlace:string>>, "
    f"publisher array<struct<pubName:array<struct<_claimant:string,_VALUE:string>>,pubPlace:array<string>,pubDate:{_DATED}>>, "
    "claimant array<string>, `prev-regNum` array<string>, "
    f"regDate {_DATED}, copyDate {_DATED}, pubDate {_DATED}, affDate {_DATED}, noticeDate {_DATED}, "
    f"additionalEntry array<struct<_regnum:string,regNum:string,regDate:{_DATED}>>"
)
MARC_YEARS, REGISTRATION_YEARS = (1450, 2050), (1700, 2100)


def _read(spark: SparkSession, path: str, tag: str, schema: str, recursive: bool) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", tag).option("ignoreNamespace", "true").option("ignoreSurroundingSpaces", "false")
    return reader.option("recursiveFileLookup", str(recursive).lower()).schema(schema).load(path)


def trailing_clean(text: Column) -> Column:
    """Trimmed, without trailing / : ; , = . and blanks, mojibake repaired; empty becomes null."""
    return F.nullif(F.trim(clean_text(F.regexp_replace(F.trim(text), r"[ /:;,=.]+$", ""))), F.lit(""))


def _fields(*tags: str) -> Column:
    return F.filter(F.coalesce("datafield", F.array().cast(MARC_SCHEMA.split("datafield ")[1])), lambda f: f["_tag"].isin(*tags))


def _values(code: str, *tags: str) -> Column:
    """All values of a subfield in fields of the tags, in order."""
    found = F.flatten(F.transform(_fields(*tags), lambda f: F.transform(F.filter(f["subfield"], lambda s: s["_code"] == code), lambda s: s["_VALUE"])))
    return F.filter(found, lambda v: F.trim(F.coalesce(v, F.lit(""))) != "")


def _first(code: str, *tags: str) -> Column:
    return F.get(_values(code, *tags), F.lit(0))


def _control(tag: str) -> Column:
    return F.get(F.transform(F.filter("controlfield", lambda f: f["_tag"] == tag), lambda f: f["_VALUE"]), F.lit(0))


def _year_between(text: Column, years: tuple[int, int]) -> Column:
    year = text.try_cast("int")
    return F.when(year.between(*years), year)


def marc_columns() -> dict[str, Column]:
    fixed = F.coalesce(_control("008"), F.lit(""))
    a, b = trailing_clean(_first("a", "245")), trailing_clean(_first("b", "245"))
    date = _first("c", "260", "264")
    part = lambda start, n: F.nullif(F.trim(F.substring(fixed, start, n)), F.lit(""))
    oclc = F.filter(_values("a", "035"), lambda v: v.startswith("(OCoLC)"))
    all_clean = lambda values: F.filter(F.transform(values, lambda v: F.regexp_replace(F.trim(v), r"[ /:;,=.]+$", "")), lambda v: v != "")
    return {
        "control_id": F.nullif(F.trim(_control("001")), F.lit("")),
        "title": F.when(a.isNotNull(), F.concat_ws(" ", a, b)), "title_main": a,
        "lccn": F.nullif(F.trim(_first("a", "010")), F.lit("")), "oclc": F.trim(F.regexp_replace(F.get(oclc, F.lit(0)), r"^\(OCoLC\)", "")), "isbns": _values("a", "020"),
        "title_part_number": trailing_clean(_first("n", "245")), "title_part_name": trailing_clean(_first("p", "245")),
        "main_author": trailing_clean(_first("a", "100", "110", "111")), "added_authors": all_clean(_values("a", "700")),
        "statement_of_responsibility": trailing_clean(_first("c", "245")), "edition": trailing_clean(_first("a", "250")),
        "place": trailing_clean(_first("a", "260", "264")), "publisher": trailing_clean(_first("b", "260", "264")), "publication_date_raw": date,
        "publication_year": F.coalesce(_year_between(F.regexp_extract(date, r"(\d{4})", 1), MARC_YEARS), _year_between(F.regexp_extract(F.substring(fixed, 8, 4), r"^(\d{4})$", 1), MARC_YEARS)),
        "extent": trailing_clean(_first("a", "300")), "series_titles": all_clean(_values("a", "440", "490", "830")), "notes": all_clean(_values("a", "500", "502", "505", "520")),
        "language_code": part(36, 3), "country_code": part(16, 3),
    }


def _raw_marc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the XML files at path: one file, or the *.xml files of a folder, not of those below."""
    return _read(spark, path if path.endswith(".xml") or "*" in path else f"{path.rstrip('/')}/*.xml", "record", MARC_SCHEMA, False)


def read_pool(spark: SparkSession, path: str, languages: tuple[str, ...]) -> DataFrame:
    """Raw records of a pool with one folder per language, with their language; a language without a folder has none."""
    rows = None
    for language in languages:
        try:
            one = _raw_marc(spark, f"{path}/{language}").withColumn("pool_language", F.lit(language))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        rows = one if rows is None else rows.union(one)
    return rows if rows is not None else spark.createDataFrame([], f"{MARC_SCHEMA}, pool_language string")


def read_wanted(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Raw records whose control id is in wanted (control_id)."""
    ids = wanted.select(F.col("control_id").alias("_wanted")).distinct()
    return _raw_marc(spark, path).join(ids, F.trim(_control("001")) == F.col("_wanted"), "left_semi")


def parse_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row on the records at path: emitted, skipped by reason, titles repaired, years out of range."""
    rows = _raw_marc(spark, path)
    date = F.regexp_extract(F.coalesce(_first("c", "260", "264"), F.lit("")), r"(\d{4})", 1).try_cast("int")
    raw = F.trim(_first("a", "245"))
    named = F.coalesce(F.trim(_control("001")), F.lit("")) != ""
    titled = trailing_clean(_first("a", "245")).isNotNull()
    n = lambda c: F.count(F.when(c, 1))
    return rows.agg(n(named & titled).alias("emitted"), n(~named).alias("no_control_id"), n(named & ~titled).alias("no_title"), n(raw != clean_text(raw)).alias("repaired"), n(~date.between(*MARC_YEARS)).alias("year_out_of_range"))


def read_marc(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Catalogue records with an identifier and a title, and counts of the others by reason."""
    rows = _raw_marc(spark, path).select("leader", *(c.alias(n) for n, c in marc_columns().items()))
    reason = F.when(F.col("control_id").isNull(), "no_control_id").when(F.col("title_main").isNull(), "no_title").otherwise("kept")
    counts = rows.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    return rows.where("control_id is not null and title_main is not null").drop("leader"), counts


#: Reasons in the order in which they are tested; the corpus ends before the moving wall and at this year.
LAST_YEAR = 1977


def eligibility(min_year: int, leader: Column, fixed: Column, electronic: Column, title: Column) -> Column:
    """The first reason why a record is no printed monograph of the corpus, or 'eligible'."""
    year = F.regexp_extract(F.substring(fixed, 8, 4), r"^(\d{4})$", 1).try_cast("int")
    return (
        F.when(F.substring(leader, 7, 1) != "a", "not_text").when(F.substring(leader, 8, 1) != "m", "not_monograph").when(electronic, "electronic")
        .when(F.length(F.coalesce(fixed, F.lit(""))) < 38, "short_008").when(~F.substring(fixed, 36, 3).isin("eng", "fre", "ger", "spa", "ita"), "language")
        .when(year.isNull(), "no_year").when(year < min_year, "too_early").when(year > LAST_YEAR, "too_late").when(~F.substring(fixed, 29, 1).isin(" ", "|"), "government")
        .when(F.trim(F.coalesce(title, F.lit(""))) == "", "no_title").otherwise("eligible")
    )


def is_electronic() -> Column:
    starts = F.coalesce(F.substring(_control("007"), 1, 1) == "c", F.lit(False))
    has = lambda text, *where: F.exists(_values(*where), lambda v: F.contains(F.lower(v), F.lit(text)))
    return starts | F.exists(_values("b", "338"), lambda v: v == "cr") | has("electronic resource", "h", "245") | has("online resource", "a", "300")


def eligible_marc(spark: SparkSession, path: str, min_year: int) -> DataFrame:
    """(control_id, reason, language) of all records."""
    rows = _raw_marc(spark, path)
    return rows.select(F.trim(_control("001")).alias("control_id"), eligibility(min_year, F.col("leader"), _control("008"), is_electronic(), _first("a", "245")).alias("reason"), F.substring(_control("008"), 36, 3).alias("language"))


def moving_wall(today: Column | None = None) -> Column:
    """The first year whose works may still be protected: 95 years before today's."""
    return F.year(today if today is not None else F.current_date()) - 95


def filtered(rows: DataFrame, languages: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """Of rows (reason, language, ...) the eligible ones, and (reason, n) of all; the allowed languages are tested last."""
    reason = F.col("reason")
    if languages is not None:
        reason = F.when((reason == "eligible") & ~F.coalesce(F.col("language").isin(*languages), F.lit(False)), "language_not_asked").otherwise(reason)
    judged = rows.withColumn("reason", reason)
    return judged.where("reason = 'eligible'").drop("reason"), judged.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _dated_year(c: Column) -> Column:
    inside = lambda text: _year_between(F.regexp_extract(F.coalesce(text, F.lit("")), r"(\d{4})", 1), REGISTRATION_YEARS)
    return F.coalesce(inside(c["_date"]), inside(c["_VALUE"]))


def read_registrations(spark: SparkSession, path: str) -> DataFrame:
    """Registrations with an id and a title from all files below path."""
    rows = _read(spark, path, "copyrightEntry", REGISTRATION_SCHEMA, True)
    texts = lambda values: F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.trim(v)), lambda v: v != "")
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    names = F.flatten(F.coalesce(F.transform("publisher", lambda p: F.coalesce(p["pubName"], F.array().cast("array<struct<_claimant:string,_VALUE:string>>"))), F.array().cast("array<array<struct<_claimant:string,_VALUE:string>>>")))
    places = F.flatten(F.coalesce(F.transform("publisher", lambda p: F.coalesce(p["pubPlace"], F.array().cast("array<string>"))), F.array().cast("array<array<string>>")))
    author = F.get("author", F.lit(0))
    published = F.coalesce(_dated_year(F.col("pubDate")), F.get(F.filter(F.transform("publisher", lambda p: _dated_year(p["pubDate"])), lambda y: y.isNotNull()), F.lit(0)))
    more = F.transform("additionalEntry", lambda e: F.struct(blank(F.coalesce(e["_regnum"], e["regNum"])).alias("regnum"), _dated_year(e["regDate"]).alias("year")))
    out = rows.select(
        blank(F.col("_id")).alias("uuid"), blank(clean_text("title")).alias("title"), F.coalesce(blank(F.col("_regnum")), blank(F.col("regNum"))).alias("regnum"),
        F.col("regDate._date").try_cast("date").alias("reg_date"), F.coalesce(_dated_year(F.col("regDate")), _dated_year(F.col("copyDate")), published).alias("reg_year"),
        blank(author["authorName"]).alias("author_name"), blank(author["authorPlace"]).alias("author_place"), F.coalesce(author["_claimant"] == "yes", F.lit(False)).alias("author_is_claimant"),
        blank(F.col("edition")).alias("edition"), texts(F.transform(names, lambda n: n["_VALUE"])).alias("publisher_names"), texts(places).alias("publication_places"),
        F.concat(texts(F.transform(F.filter(names, lambda n: n["_claimant"] == "yes"), lambda n: n["_VALUE"])), texts(F.col("claimant"))).alias("claimants"),
        blank(F.col("copies")).alias("copies"), blank(F.col("affDate._VALUE")).alias("aff_date"), blank(F.col("desc")).alias("desc"), texts(F.col("note")).alias("notes"),
        blank(F.col("newMatterClaimed")).alias("new_matter_claimed"), blank(F.col("copyDate._VALUE")).alias("copy_date"), blank(F.col("noticeDate._VALUE")).alias("notice_date"),
        F.coalesce(blank(F.col("lccn._normalized")), blank(F.col("lccn._VALUE"))).alias("lccn"), texts(F.col("prev-regNum")).alias("prev_regnums"),
        F.coalesce(F.filter(more, lambda e: e["regnum"].isNotNull() & e["year"].isNotNull()), F.array().cast("array<struct<regnum:string,year:int>>")).alias("additional_keys"),
    )
    return out.where("uuid is not null and title is not null")


def registration_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row on the registrations below path: emitted, skipped for want of an id or a title, titles repaired, registration years out of range."""
    rows = _read(spark, path, "copyrightEntry", REGISTRATION_SCHEMA, True)
    named, raw = F.trim(F.coalesce("_id", F.lit(""))) != "", F.trim(F.coalesce("title", F.lit("")))
    year = F.regexp_extract(F.coalesce("regDate._date", "regDate._VALUE", F.lit("")), r"(\d{4})", 1).try_cast("int")
    n = lambda c: F.count(F.when(c, 1))
    return rows.agg(n(named & (raw != "")).alias("emitted"), n(~named).alias("no_id"), n(named & (raw == "")).alias("no_title"), n(raw != clean_text(raw)).alias("repaired"), n(~year.between(*REGISTRATION_YEARS)).alias("year_out_of_range"))


def registration_keys(registrations: DataFrame) -> DataFrame:
    """(uuid, keys): the join keys of a registration in order of priority, its own first."""
    own = F.coalesce(identifiers.renewal_keys(F.col("regnum"), F.col("reg_year")), F.array().cast("array<struct<regnum:string,year:int>>"))
    more = F.flatten(F.transform("additional_keys", lambda e: identifiers.renewal_keys(e["regnum"], e["year"])))
    return registrations.select("uuid", F.filter(F.concat(own, more), lambda k: k["year"].isNotNull()).alias("keys"))


def write_marc(rows: DataFrame, path: str, per_file: int = 5000) -> None:
    """Records of the raw schema as XML files of at most per_file records."""
    rows.write.format("xml").option("rowTag", "record").option("rootTag", "collection").option("maxRecordsPerFile", per_file).mode("overwrite").save(path)
