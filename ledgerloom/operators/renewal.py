"""Build-time joins of renewals onto registrations, and of registrations onto the ones they cite."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_renewals(renewals: DataFrame, order: str) -> DataFrame:
    """(regnum, year, entry_id): of renewals with one key, the last in order."""
    return renewals.where("regnum <> '' and year is not null").groupBy("regnum", "year").agg(F.max_by("entry_id", order).alias("entry_id"))


def first_hit(keys: DataFrame, renewals: DataFrame, id_: str) -> DataFrame:
    """(id, entry_id): for records with an array `keys` of (regnum, year) in priority order, the renewal of the first key that has one."""
    rows = keys.select(id_, F.posexplode("keys").alias("place", "k")).select(id_, "place", "k.regnum", "k.year")
    return rows.join(renewals, ["regnum", "year"]).groupBy(id_).agg(F.min_by("entry_id", "place").alias("entry_id"))


def sibling_renewals(records: DataFrame, id_: str) -> DataFrame:
    """(id, sibling, sibling_entry): un-renewed records and a renewed one that they cite or that cites them.

    records has regnum, year, cited (array of regnums) and entry_id (null if not renewed). A citation holds in the citing year or
    the one before. Of several siblings the one with the greatest id counts.
    """
    cites = records.select(F.col(id_).alias("a"), F.col("entry_id").alias("ea"), "year", F.explode("cited").alias("regnum"))
    cites = cites.withColumn("year", F.explode(F.array("year", F.col("year") - 1)))
    cited = records.where("regnum <> ''").select(F.col(id_).alias("b"), F.col("entry_id").alias("eb"), "regnum", "year")
    pairs = cites.join(cited, ["regnum", "year"]).where("a <> b")
    down = pairs.where("ea is null and eb is not null").select(F.col("a").alias(id_), F.col("b").alias("sibling"), F.col("eb").alias("sibling_entry"))
    up = pairs.where("eb is null and ea is not null").select(F.col("b").alias(id_), F.col("a").alias("sibling"), F.col("ea").alias("sibling_entry"))
    return down.union(up).groupBy(id_).agg(F.max_by("sibling_entry", "sibling").alias("sibling_entry"), F.max("sibling").alias("sibling"))


def fanout(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """(matches, n): how many keys of left have how many rows of right, in classes 0..5, 6-10, 11-50, 51-100, 101+."""
    n = left.select(*keys).distinct().join(right.groupBy(*keys).agg(F.count(F.lit(1)).alias("m")), keys, "left").select(F.coalesce("m", F.lit(0)).alias("m"))
    m = F.col("m")
    label = F.when(m <= 5, m.cast("string")).when(m <= 10, "6-10").when(m <= 50, "11-50").when(m <= 100, "51-100").otherwise("101+")
    return n.groupBy(label.alias("matches")).agg(F.count(F.lit(1)).alias("n"))


def joined_by_scheme(registrations: DataFrame, renewals: DataFrame) -> DataFrame:
    """(scheme, joined, single): renewals that find a registration by raw or normalised number, with day, year or neither, and how many find just one.

    Both sides have id, raw, norm, day and year.
    """
    schemes = {"raw_day": ("raw", "day"), "norm_day": ("norm", "day"), "norm_year": ("norm", "year"), "norm": ("norm",)}
    keyed = lambda df: df.select("id", F.explode(F.array(*(F.struct(F.lit(s).alias("scheme"), F.when(F.greatest(*(F.col(c).isNull() for c in cols)) if len(cols) > 1 else F.col(cols[0]).isNull(), None).otherwise(F.concat_ws("|", *(F.col(c).cast("string") for c in cols))).alias("k")) for s, cols in schemes.items()))).alias("e")).select("id", "e.scheme", "e.k").where("k is not null and k <> ''")
    counts = keyed(registrations).groupBy("scheme", "k").agg(F.countDistinct("id").alias("m"))
    hits = keyed(renewals).join(counts, ["scheme", "k"]).groupBy("scheme").agg(F.countDistinct("id").alias("joined"), F.count(F.when(F.col("m") == 1, 1)).alias("single"))
    return hits


def class_folds(numbers: DataFrame, raw: str) -> DataFrame:
    """(class, folded, n): how many numbers each class has before and after written-out classes are folded."""
    from ..functions import identifiers

    plain = F.regexp_extract(F.regexp_replace(F.upper(F.trim(raw)), "[^A-Z0-9]", ""), "^[A-Z]*", 0)
    return numbers.groupBy(plain.alias("class"), identifiers.reg_class(F.col(raw)).alias("folded")).agg(F.count(F.lit(1)).alias("n"))


def range_sizes(registrations: DataFrame, raw: str) -> DataFrame:
    """(size, n): registrations of several numbers by how many they have."""
    from ..functions import identifiers

    ranges = registrations.where(identifiers.is_multi_regnum(F.col(raw)))
    return ranges.groupBy(F.size(F.split(F.trim(raw), r"\s+")).alias("size")).agg(F.count(F.lit(1)).alias("n"))


def recovered(hits: DataFrame, id_: str, own: str = "place") -> DataFrame:
    """One row: records that join by their own number, and those that only an additional entry joins. hits has (id, place) of every key that found a renewal."""
    first = hits.groupBy(id_).agg(F.min(own).alias("p"))
    return first.agg(F.count(F.when(F.col("p") == 0, 1)).alias("own"), F.count(F.when(F.col("p") > 0, 1)).alias("additional"))
