"""Sampling, active learning, and the store of labelled pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def capped(rows: DataFrame, strata: list[str], order: list[Column], cap: Column | int) -> DataFrame:
    """The first `cap` rows of each stratum; the rank limit also applies before the shuffle."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*strata).orderBy(*order))).where(F.col("place") <= cap)


def reservoir(rows: DataFrame, strata: list[str], key: str, k: Column | int, seed: int = 0, order: Column | None = None) -> DataFrame:
    """k rows of each stratum in the order of a hash of seed, stratum and key (or of `order`): the same on every run. k of 0 or less gives none."""
    mixed = order if order is not None else F.xxhash64(F.lit(seed), *strata, key)
    return capped(rows.withColumn("_h", mixed), strata, [F.col("_h"), F.col(key)], k).drop("_h", "place")


def scaled(cap: Column, factor: float) -> Column:
    return F.greatest(F.lit(1), F.bround(cap * F.lit(factor))).cast("int")


def disagreement(pick_a: Column, score_a: Column, pick_b: Column, score_b: Column) -> Column:
    """The gap between two scorers' scores, plus one where they choose differently; 0 where neither chooses."""
    gap = F.abs(F.coalesce(score_a, F.lit(0.0)) - F.coalesce(score_b, F.lit(0.0)))
    return F.when(pick_a.isNull() & pick_b.isNull(), 0.0).otherwise(gap + F.when(pick_a.eqNullSafe(pick_b), 0.0).otherwise(1.0))


def disagreement_bucket(pick_a: Column, score_a: Column, pick_b: Column, score_b: Column) -> Column:
    same = pick_a.eqNullSafe(pick_b)
    return F.when(same & (score_a >= 0.7) & (score_b >= 0.7), "agree_high").when(same & (score_a <= 0.3) & (score_b <= 0.3), "agree_low").otherwise("informative")


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key. Aggregation, not a window: the rows of a key need not meet in one task."""
    others = [c for c in rows.columns if c not in keys]
    best = F.max(F.struct(*order, *(c for c in others if c not in order))).alias("_last")
    return rows.groupBy(*keys).agg(best).select(*(F.col(c) if c in keys else F.col(f"_last.`{c}`") for c in rows.columns))


def upsert(store: DataFrame, changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """store with changes: the last row of each key in order wins."""
    return latest(store.unionByName(changes), keys, order)


def missing(wanted: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    return wanted.join(present.select(*keys).distinct(), keys, "left_anti")


#: Bands of scores, the best first; `below` is sampled at random, the others are taken in order.
BANDS = ("ge90", "b80_90", "b70_80", "b60_70", "below")

#: Pairs to label by language and band.
BUDGET = {
    "eng": {"ge90": 500, "b80_90": 200, "b70_80": 200, "b60_70": 200, "below": 300},
    "fre": {"ge90": 60, "b80_90": 30, "b70_80": 30, "b60_70": 30, "below": 80},
    "ger": {"ge90": 60, "b80_90": 30, "b70_80": 30, "b60_70": 30, "below": 80},
    "spa": {"ge90": 60, "b80_90": 30, "b70_80": 30, "b60_70": 30, "below": 80},
    "ita": {"ge90": 60, "b80_90": 30, "b70_80": 30, "b60_70": 30, "below": 80},
}

#: Shares of languages among the records to label.
LANGUAGE_WEIGHTS = {"eng": 0.70, "fre": 0.075, "ger": 0.075, "ita": 0.075, "spa": 0.075}


def budget_table(spark: SparkSession, total: int | None = None, caps: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """(language, band, cap): the budget, scaled to about `total` pairs where that is given; no cap above 0 falls below 1."""
    caps = caps if caps is not None else BUDGET
    rows = [(lang, band, cap) for lang, bands in caps.items() for band, cap in bands.items()]
    df = spark.createDataFrame(rows, "language string, band string, cap int")
    if total is None:
        return df
    whole = sum(cap for _, _, cap in rows)
    if total <= 0 or whole <= 0:
        raise ValueError("a budget is scaled from and to a positive total")
    return df.withColumn("cap", F.when(F.col("cap") > 0, scaled(F.col("cap"), total / whole)).otherwise(0))


def stratified(pairs: DataFrame, budget: DataFrame, key: str, order: list[Column], seed: int = 0) -> DataFrame:
    """The first pairs of each language and band in order, and of the band `below` a random draw, as many as the budget says. pairs has language and band."""
    capped_rows = pairs.join(budget, ["language", "band"])
    first = capped(capped_rows.where("band <> 'below'"), ["language", "band"], order, F.col("cap")).drop("place")
    return first.unionByName(reservoir(capped_rows.where("band = 'below'"), ["language", "band"], key, F.col("cap"), seed)).drop("cap")


def language_targets(spark: SparkSession, target: int, weights: dict[str, float] | None = None) -> DataFrame:
    """(language, target): records to label of each language, at least 1 for a weight above 0."""
    weights = LANGUAGE_WEIGHTS if weights is None else weights
    if target <= 0 or not weights or any(w < 0 for w in weights.values()):
        raise ValueError("a positive target and weights of 0 or more are needed")
    df = spark.createDataFrame(list(weights.items()), "language string, weight double")
    return df.select("language", F.when(F.col("weight") > 0, F.greatest(F.lit(1), F.bround(F.col("weight") * target))).otherwise(0).cast("int").alias("target"))


def selected_records(records: DataFrame, labelled: DataFrame, targets: DataFrame, key: str = "control_id", seed: int = 0) -> DataFrame:
    """A draw of records with a year that nobody has labelled, as many of each language as its target. records has language and publication_year."""
    open_ = missing(in_scope(records), labelled, [key]).join(targets, "language")
    return reservoir(open_, ["language"], key, F.col("target"), seed).drop("target")


def selection_plan(records: DataFrame, labelled: DataFrame, targets: DataFrame, key: str = "control_id") -> DataFrame:
    """(language, target, selected, excluded, out_of_scope) of such a draw."""
    known = labelled.select(key).distinct().withColumn("_known", F.lit(True))
    rows = records.join(known, key, "left").groupBy("language").agg(
        F.count(F.when(F.col("_known"), 1)).alias("excluded"), F.count(F.when(F.col("_known").isNull() & F.col("publication_year").isNull(), 1)).alias("out_of_scope"),
        F.count(F.when(F.col("_known").isNull() & F.col("publication_year").isNotNull(), 1)).alias("_open"))
    rows = targets.join(rows, "language", "left").fillna(0)
    return rows.select("language", "target", F.least("target", "_open").cast("int").alias("selected"), "excluded", "out_of_scope")


def in_scope(records: DataFrame) -> DataFrame:
    return records.where("publication_year is not null")


def gold_labels(vault: DataFrame) -> DataFrame:
    """Labels that an evaluation may use: not unsure, and not made on renewals."""
    return vault.where((F.col("verdict") != "unsure") & (F.coalesce("match_source", F.lit("registration")) != "renewal"))


def requeued(queue: DataFrame, verdicts: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """The rows whose verdict is not among `verdicts`, and (verdict, n) of those dropped."""
    chosen = F.coalesce(F.col("verdict").isin(*verdicts), F.lit(False))
    return queue.where(~chosen), queue.where(chosen).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def truth_of(labels_: DataFrame, order: str) -> DataFrame:
    """(marc_control_id, nypl_uuid): the last match of each record; other verdicts say nothing."""
    return labels_.where("verdict = 'match'").groupBy("marc_control_id").agg(F.max_by("nypl_uuid", order).alias("nypl_uuid"))


def listed(pairs: DataFrame, verdict: str | None = None, language: str | None = None, contains: str | None = None, fields: tuple[str, ...] = (), categories: tuple[str, ...] = ()) -> DataFrame:
    """Labelled pairs by verdict, language, text in any of the fields (whatever its case), and any of the categories."""
    if verdict is not None:
        pairs = pairs.where(F.col("verdict") == verdict)
    if language is not None:
        pairs = pairs.where(F.col("language") == language)
    if contains:
        hits = [F.contains(F.lower(F.coalesce(F.col(f), F.lit(""))), F.lit(contains.lower())) for f in fields]
        pairs = pairs.where(F.exists(F.array(*hits), lambda h: h))
    return any_category(pairs, categories) if categories else pairs


def any_category(pairs: DataFrame, categories: tuple[str, ...]) -> DataFrame:
    return pairs.where(F.coalesce(F.arrays_overlap("categories", F.array(*map(F.lit, categories))), F.lit(False)))


def dual_picks(scored: DataFrame, key: str, other: str, combiners: list[str]) -> DataFrame:
    """(key, pick and score of each combiner): its best candidate of each record, the first of equals by `other`."""
    least = {c: F.min(F.struct((-F.col(c)).alias("s"), F.col(other).alias("o"))) for c in combiners}
    aggs = [column for c, x in least.items() for column in (x["o"].alias(f"{c}_pick"), (-x["s"]).alias(f"{c}_score"))]
    return scored.groupBy(key).agg(*aggs)


def dual_scores(scored: DataFrame, key: str, other: str, a: str, b: str) -> DataFrame:
    """The picks of two combiners with their disagreement and its bucket."""
    rows = dual_picks(scored, key, other, [a, b])
    args = [F.col(f"{a}_pick"), F.col(f"{a}_score"), F.col(f"{b}_pick"), F.col(f"{b}_score")]
    return rows.withColumns({"gap": disagreement(*args), "bucket": disagreement_bucket(*args)})


def most_informative(rows: DataFrame, key: str) -> DataFrame:
    """Rows by disagreement, the greatest first; ties by key."""
    return rows.orderBy(F.desc("gap"), key)


BUCKETS = ("agree_high", "agree_low", "informative")


def bucket_statistics(rows: DataFrame) -> DataFrame:
    """(bucket, n, least, most, mean) for each of the three buckets; zeros for those without rows."""
    spark = rows.sparkSession
    sums = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("gap").alias("least"), F.max("gap").alias("most"), F.avg("gap").alias("mean"))
    return spark.createDataFrame([(b,) for b in BUCKETS], "bucket string").join(sums, "bucket", "left").fillna(0).fillna(0.0)


def disagreements_of_labels(picks: DataFrame, truth: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """(kind, n): how often two combiners are right and wrong about labelled records."""
    rows = picks.join(truth, key)
    right = lambda c: F.coalesce(F.col(f"{c}_pick") == F.col("truth"), F.lit(False))
    kind = F.when(right(a) & right(b), "both_right").when(right(a), "first_right").when(right(b), "second_right").otherwise("both_wrong")
    return rows.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def build_queue(matched: DataFrame, labelled: DataFrame, budget: DataFrame, seed: int = 0) -> DataFrame:
    """The pairs to label next: unlabelled ones, banded by calibrated score, as many of each language and band as the budget says.

    matched has control_id, uuid, language, calibrated and an order column seq.
    """
    from ..functions import signals

    open_ = missing(matched, labelled.select(F.col("marc_control_id").alias("control_id"), F.col("nypl_uuid").alias("uuid")), ["control_id", "uuid"])
    banded = open_.withColumn("band", signals.score_band(F.col("calibrated"))).withColumn("pair", F.concat_ws("|", "control_id", "uuid"))
    return stratified(banded, budget, "pair", [F.col("seq"), F.col("pair")], seed).drop("pair")


def stratum_counts(pairs: DataFrame) -> DataFrame:
    """(language, band, n)."""
    return pairs.groupBy("language", "band").agg(F.count(F.lit(1)).alias("n"))


def progress(pairs: DataFrame, labels_: DataFrame) -> DataFrame:
    """(language, total, labelled, match, no_match, unsure): one row per language, by the last label of each pair."""
    last = latest(labels_.select("pair_id", "id", "verdict"), ["pair_id"], ["id"])
    rows = pairs.select(F.col("id").alias("pair_id"), "language").join(last.drop("id"), "pair_id", "left")
    kinds = [F.count(F.when(F.col("verdict") == v, 1)).alias(v) for v in ("match", "no_match", "unsure")]
    return rows.groupBy("language").agg(F.count(F.lit(1)).alias("total"), F.count("verdict").alias("labelled"), *kinds)


def resolved(vault: DataFrame, marc: DataFrame, cce: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labelled pairs with both of their records, and one row counting the pairs and what each lacks."""
    a = marc.select(F.col("control_id").alias("marc_control_id"), F.struct("*").alias("marc"))
    b = cce.select(F.col("uuid").alias("nypl_uuid"), F.struct("*").alias("cce"))
    rows = vault.join(a, "marc_control_id", "left").join(b, "nypl_uuid", "left")
    counts = rows.agg(
        F.count(F.lit(1)).alias("pairs"), F.count(F.when(F.col("marc").isNull(), 1)).alias("no_marc"), F.count(F.when(F.col("marc").isNotNull() & F.col("cce").isNull(), 1)).alias("no_cce"),
        F.count(F.when(F.col("marc").isNotNull() & F.col("cce").isNotNull(), 1)).alias("resolved"))
    return rows.where("marc is not null and cce is not null"), counts


def enriched(vault: DataFrame, cce: DataFrame, scores: DataFrame, version: str) -> DataFrame:
    """The label store with facts of its registrations and scores rounded to four places. scores has marc_control_id, nypl_uuid, weighted_mean, learned."""
    facts = cce_facts(cce)
    kept = [c for c in vault.columns if c not in ("reg_year", "renewal_year", "was_renewed", "cce_regnum", "cce_renewal_id", "scores", "matcher_version")]
    rounded = F.struct(F.round("weighted_mean", 4).alias("weighted_mean"), F.round("learned", 4).alias("learned"))
    scored = scores.select("marc_control_id", "nypl_uuid", rounded.alias("scores"))
    return vault.select(*kept).join(facts, "nypl_uuid", "left").join(scored, ["marc_control_id", "nypl_uuid"], "left").withColumn("matcher_version", F.lit(version))


def cce_facts(cce: DataFrame) -> DataFrame:
    """What the label store keeps of a registration: number, year, whether and when it was renewed."""
    return cce.select(F.col("uuid").alias("nypl_uuid"), F.col("regnum").alias("cce_regnum"), "reg_year", F.coalesce("was_renewed", F.lit(False)).alias("was_renewed"),
                      F.col("renewal_id").alias("cce_renewal_id"), F.year("renewal_date").alias("renewal_year"))


#: Steps of the label store: the version that a field came with and its default. Version 3 turned one category into a list, 7 took the matcher's
#: version out of the scores, and 8 says on which arm a pair was labelled.
MIGRATIONS = {
    3: {"categories": "case when category is null or category = '' then array() else array(category) end"},
    4: {"reg_year": "cast(null as int)", "renewal_year": "cast(null as int)"},
    5: {"was_renewed": "renewal_year is not null"},
    6: {"scores": "cast(null as struct<weighted_mean:double,learned:double>)"},
    7: {"matcher_version": "cast(null as string)"},
    8: {"match_source": "'registration'"},
}


def migrate(store: DataFrame, to: int = 8) -> DataFrame:
    """store with all fields of schema `to`: rows of older schemas get what each step makes of them, newer rows stay as they are."""
    if "category" not in store.columns:
        store = store.withColumn("category", F.lit(None).cast("string"))
    for version, fields in MIGRATIONS.items():
        if version > to:
            continue
        for name, default in fields.items():
            old = F.expr(default)
            store = store.withColumn(name, F.when((F.col("schema") < version) & F.col(name).isNull(), old).otherwise(F.col(name)) if name in store.columns else old)
    return store.withColumn("schema", F.greatest(F.col("schema"), F.lit(to))).drop("category")
