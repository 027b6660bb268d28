"""Evaluation of scores and linkages.

Curves need sums in order of score. Rows are first counted by score, so the ordered window sees one row per distinct score, not one per record.
Scores are rounded to `digits` places first, which bounds these rows: areas are those of the rounded scores, exact where scores have no more places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def by_score(scored: DataFrame, digits: int = 4) -> DataFrame:
    """(score, n, pos) from rows (score, label)."""
    return scored.groupBy(F.round("score", digits).alias("score")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("long")).alias("pos"))


def roc_auc(scored: DataFrame, digits: int = 4) -> DataFrame:
    """One row (auc, positives, negatives): share of (positive, negative) pairs in order, ties half; 0.5 with one class."""
    below = Window.partitionBy(F.lit(0)).orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    rows = by_score(scored, digits).withColumn("neg", F.col("n") - F.col("pos"))
    rows = rows.withColumn("won", F.col("pos") * (F.coalesce(F.sum("neg").over(below), F.lit(0)) + F.col("neg") / 2))
    total = rows.agg(F.sum("won").alias("won"), F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"), F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"))
    pairs = F.col("positives") * F.col("negatives")
    return total.select(F.when(pairs > 0, F.col("won") / pairs).otherwise(0.5).alias("auc"), "positives", "negatives")


def average_precision(scored: DataFrame, digits: int = 4) -> DataFrame:
    """One row (ap): mean precision over the positives, at the end of each score; 0 without positives."""
    down = Window.partitionBy(F.lit(0)).orderBy(F.desc("score"))
    rows = by_score(scored, digits).withColumn("hits", F.sum("pos").over(down)).withColumn("seen", F.sum("n").over(down))
    return rows.agg(F.try_divide(F.sum(F.col("pos") * F.col("hits") / F.col("seen")), F.sum("pos")).alias("ap")).select(F.coalesce("ap", F.lit(0.0)).alias("ap"))


def threshold_sweep(scored: DataFrame, steps: int = 20, digits: int = 4) -> DataFrame:
    """Precision, recall and F1 at steps + 1 thresholds from 0 to 1; a score at the threshold is positive."""
    grid = F.explode(F.transform(F.sequence(F.lit(0), F.lit(steps)), lambda i: F.round(i / steps, 4)))
    rows = by_score(scored, digits).withColumn("threshold", grid)
    hit = F.col("score") >= F.col("threshold")
    sums = rows.groupBy("threshold").agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(hit, F.col("n") - F.col("pos")).otherwise(0)).alias("fp"), F.sum(F.when(~hit, F.col("pos")).otherwise(0)).alias("fn"))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    sums = sums.withColumn("precision", share(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", share(F.col("tp"), F.col("tp") + F.col("fn")))
    return sums.withColumn("f1", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def linkage_quality(top: DataFrame, truth: DataFrame, key: str, other: str) -> DataFrame:
    """One row: records with a known match, with a top match, and with the right one; precision over tops, recall over known."""
    both = truth.select(F.col(key), F.col(other).alias("_true")).join(top.select(F.col(key), F.col(other).alias("_top")), key, "left")
    sums = both.agg(F.count(F.lit(1)).alias("evaluated"), F.count("_top").alias("with_top"), F.count(F.when(F.col("_top") == F.col("_true"), 1)).alias("correct"))
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return sums.select("*", share("correct", "with_top").alias("precision"), share("correct", "evaluated").alias("recall"))


def gate_passes(measured: dict[str, float], baseline: dict[str, float], tolerance: float = 0.02) -> dict[str, bool]:
    """Whether precision and recall are each at most `tolerance` below the baseline."""
    return {k: measured[k] >= baseline[k] - tolerance for k in ("precision", "recall")}


def nearest_rank(rows: DataFrame, value: str, share: float, bins: int = 4096, few: int = 100_000) -> DataFrame:
    """One row (value): the value at place floor(share * (n - 1)) in order; none without rows. Nulls do not count.

    The range that holds the place is cut into bins and counted, bin by bin, until its rows are few or equal; only these are put in order. Each
    round is one aggregation to at most `bins` rows, so no task sorts the table.
    """
    numbers = rows.select(F.col(value).alias("v")).where(F.col("v").isNotNull())
    low, high, n = numbers.agg(F.min("v"), F.max("v"), F.count(F.lit(1))).first()
    if not n:
        return rows.select(value).limit(0)
    place, left = int(share * (n - 1)), n
    inside = numbers
    while left > few and low < high:
        width = (float(high) - float(low)) / bins
        at = F.least(F.floor((F.col("v").cast("double") - float(low)) / width), F.lit(bins - 1)).alias("at")
        counts = sorted(tuple(r) for r in inside.groupBy(at).agg(F.count(F.lit(1)), F.min("v"), F.max("v")).collect())
        for _, count, least, most in counts:
            if place < count:
                break
            place -= count
        if count == left and (least, most) == (low, high):
            break  # no bin is narrower than the range itself
        low, high, left = least, most, count
        inside = numbers.where(F.col("v").between(low, high))
    order = Window.partitionBy(F.lit(0)).orderBy("v")
    placed = inside.groupBy("v").agg(F.count(F.lit(1)).alias("_n")).withColumn("_run", F.sum("_n").over(order))
    return placed.where(F.col("_run") > place).agg(F.min("v").alias(value))


class LabelError(ValueError):
    """A label is neither 0 nor 1."""


def check_labels(scored: DataFrame) -> DataFrame:
    """scored, if all its labels are 0 or 1; else an error. One aggregation."""
    bad = scored.where(F.col("label").isNull() | ~F.col("label").isin(0, 1)).limit(1).count()
    if bad:
        raise LabelError("labels must be 0 or 1")
    return scored


def evaluation(top: DataFrame, truth: DataFrame, scored: DataFrame, key: str, other: str) -> DataFrame:
    """One row with the linkage's precision, recall and F1, AUC and average precision of the scored labels, and the threshold sweep as an array."""
    quality = linkage_quality(top, truth, key, other)
    p, r = F.col("precision"), F.col("recall")
    quality = quality.withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))
    sweep = threshold_sweep(scored).agg(F.sort_array(F.collect_list(F.struct("threshold", "precision", "recall", "f1", "tp", "fp", "fn"))).alias("sweep"))
    return quality.crossJoin(roc_auc(scored)).crossJoin(average_precision(scored)).crossJoin(sweep)  # single rows


def write_report(report: DataFrame, path: str) -> None:
    """An evaluation as one JSON document."""
    report.coalesce(1).write.mode("overwrite").json(path)


def accuracy_by_category(predicted: DataFrame, category: str, threshold: float = 0.5) -> DataFrame:
    """(category, n, accuracy) of rows (category array or value, score, label)."""
    exploded = predicted.withColumn("_c", F.explode(F.col(category))) if predicted.schema[category].dataType.typeName() == "array" else predicted.withColumn("_c", F.col(category))
    right = (F.col("score") >= threshold).cast("int") == F.col("label")
    return exploded.groupBy(F.col("_c").alias(category)).agg(F.count(F.lit(1)).alias("n"), F.avg(right.cast("double")).alias("accuracy"))
