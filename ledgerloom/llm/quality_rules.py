"""Quality rules: robust multivariate outliers within each language and source, from built-in functions only.

Every document becomes a vector of five transformed statistics. Per group of documents (language and source; small groups
fall back to the language, then to all documents) a minimum-covariance-determinant estimate is fitted from several starts: medians
with median absolute deviations, and means with covariances of subsets that a hash chooses. Concentration steps refit mean and covariance to the
`support` share of documents with the smallest Mahalanobis distances. After two steps the start of the least determinant goes on alone, until
its determinant no longer falls. Documents beyond a distance limit are rejected.

The distances are scaled so that a group's median is that of the chi-squared distribution (the consistency factor), never below the floors of the
scales. For Gaussian vectors the 99.9 % quantile of that distribution, 20.5, would be the limit. The statistics have heavier tails: at sf0.1 that limit
rejects 5.4 % of the documents labelled good, mostly for a few repeated lines, so `limit` is 140 by default, 6.8 times the quantile. It is a parameter.

The rows of a group never meet in one task. Medians and the concentration threshold come from counts of fixed-width bins,
and means and covariances from sums, so each shuffle carries one row per group, bin and task; estimates meet the rows of their group in SALTS
parts. A threshold keeps whole bins: the fewest bins, nearest first, that hold at least the support share.

Defined results: a null text has no words and fails the base rule; null language or source form groups of their own; equal
rows get equal verdicts; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, SPACES, discard, stored, text_or_empty

STATISTICS = ("x0", "x1", "x2", "x3", "x4")
P = len(STATISTICS)
#: Least standard deviation of each transformed statistic, so that a statistic that hardly varies within a group does not reject by itself.
FLOORS = (0.25, 0.06, 0.35, 0.5, 0.5)
#: Median of the chi-squared distribution with five degrees of freedom.
CHI2_MEDIAN = 4.351460191
BIN = 1 / 64
#: Parts in which estimates meet the rows of their group, and of which single ones are the subsets that starts are taken from.
SALTS = 16
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def words_of(text: Column) -> Column:
    """The runs of characters other than white space."""
    bare = F.trim(text, F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_CLASS + "+"))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def window_hashes(words: Column, width: int = 3) -> Column:
    """A 64-bit hash of each window of `width` words; none for shorter texts."""
    window = lambda i: F.xxhash64(*(F.get(words, i + j if j else i) for j in range(width)))
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - width), window)
    return F.when(F.size(words) >= width, hashes).otherwise(F.array().cast("array<bigint>"))


def repeated_words(hashes: Column, in_order: Column, again: Column, width: int = 3, few: int = 12) -> Column:
    """How many words stand in windows that occur at least twice in the text.

    `again` has the hashes that equal their neighbour in `in_order`, the sorted hashes. Where they are few, windows are looked
    up in that list; else windows are sorted with their places and compared with their neighbours. Either way gives the places
    of all repeated windows, and a fold over them counts each covered word once.
    """
    place = lambda h, i: F.struct(h.alias("h"), i.alias("i"))
    listed = F.filter(F.transform(hashes, lambda h, i: F.when(F.array_contains(again, h), i)), lambda i: i.isNotNull())
    pairs = F.sort_array(F.transform(hashes, place))
    compared = F.sort_array(
        F.transform(F.filter(pairs, lambda x, k: (x["h"] == F.get(in_order, k - 1)) | (x["h"] == F.get(in_order, k + 1))), lambda x: x["i"])
    )
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    step = lambda s, i: F.struct((i + width).alias("end"), (s["n"] + width - F.greatest(F.lit(0), s["end"] - i)).alias("n"))
    covered = lambda places: F.aggregate(places, start, step, lambda s: s["n"])
    return F.when(F.size(again) == 0, 0).when(F.size(again) <= few, covered(listed)).otherwise(covered(compared))


def base_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (long); one pass over each text, no shuffle."""
    whole = text_or_empty(text)
    df = docs.withColumn("_words", words_of(whole)).withColumn("_lines", lines_with_words(whole))
    df = df.withColumn("_hashes", window_hashes(F.col("_words"))).withColumn("_sorted", F.sort_array("_hashes"))
    df = df.withColumn("_again", F.filter("_sorted", lambda h, k: h == F.get("_sorted", k - 1)))
    return (
        df.withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.char_length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", (F.char_length(whole) - F.char_length(F.regexp_replace(whole, "[#*$%&|<>]+", ""))).cast("long"))
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_repeat_words", F.coalesce(repeated_words(F.col("_hashes"), F.col("_sorted"), F.col("_again")), F.lit(0)).cast("long"))
        .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
        .drop("_words", "_lines", "_hashes", "_sorted", "_again")
    )


def vector(df: DataFrame) -> DataFrame:
    """The transformed statistics: logarithms of length, word length, and of symbols, repeated lines and repeated words per hundred."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    columns = (
        F.log1p(F.col("n_words").cast("double")),
        F.log(F.greatest(F.col("word_chars").cast("double"), F.lit(1.0)) / n),
        F.log1p(100 * F.col("n_symbols") / n),
        F.log1p(100 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        F.log1p(100 * F.col("n_repeat_words") / n),
    )
    return df.withColumns({name: F.round(c, 6) for name, c in zip(STATISTICS, columns, strict=True)})


def _grouped(df: DataFrame, keys: list[str], least: int) -> DataFrame:
    """df with column grp: all keys where their group has `least` rows, else fewer keys, else none."""
    names = [f"_k{i}" for i in range(len(keys))]
    tag = lambda k: F.to_json(F.struct(F.lit(k).alias("k"), *(F.col(c) for c in names[:k])), {"ignoreNullFields": "false"})
    per = df.groupBy(*(F.col(c).alias(n) for c, n in zip(keys, names, strict=True))).agg(F.count(F.lit(1)).alias(f"n{len(keys)}"))
    for k in range(len(keys) - 1, 0, -1):
        per = per.withColumn(f"n{k}", F.sum(f"n{len(keys)}").over(Window.partitionBy(*names[:k])))
    chosen = tag(0)
    for k in range(1, len(keys) + 1):
        chosen = F.when(F.col(f"n{k}") >= least, tag(k)).otherwise(chosen)
    per = per.select(*names, chosen.alias("grp"))
    return df.join(per, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(keys, names, strict=True)], "left").drop(*names)


def _binned_quantile(counts: DataFrame, keys: list[str], share: float) -> DataFrame:
    """From (keys, bin, n): the first bin at which the running count reaches share of the group."""
    whole, running = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("bin")
    return (
        counts.withColumn("total", F.sum("n").over(whole)).withColumn("run", F.sum("n").over(running))
        .where(F.col("run") >= F.ceil(F.col("total") * share)).groupBy(*keys).agg(F.min("bin").alias("bin"))
    )


def _start(rows: DataFrame) -> DataFrame:
    """Per group the medians of the statistics and their scales from median absolute deviations."""
    long = rows.select("grp", F.inline(F.array(*(F.struct(F.lit(j).alias("j"), F.col(s).alias("v")) for j, s in enumerate(STATISTICS)))))
    bins = stored(long.groupBy("grp", "j", F.floor(F.col("v") / BIN).alias("bin")).agg(F.count(F.lit(1)).alias("n")), "mcd-bins")
    median = _binned_quantile(bins, ["grp", "j"], 0.5).select("grp", "j", F.col("bin").alias("middle"))
    away = bins.join(median, ["grp", "j"]).groupBy("grp", "j", F.abs(F.col("bin") - F.col("middle")).alias("bin")).agg(F.sum("n").alias("n"))
    spread = _binned_quantile(away, ["grp", "j"], 0.5).select("grp", "j", (1.4826 * BIN * F.col("bin")).alias("scale"))
    both = median.join(spread, ["grp", "j"])
    pick = lambda j, c: F.max(F.when(F.col("j") == j, c))
    means = [pick(j, (F.col("middle") + 0.5) * BIN).alias(f"m{j}") for j in range(P)]
    spreads = [pick(j, F.greatest(F.col("scale"), F.lit(FLOORS[j]))).alias(f"l{j}{j}") for j in range(P)]
    return both.groupBy("grp").agg(*means, *spreads, *(F.lit(0.0).alias(f"l{i}{j}") for i in range(P) for j in range(i)))


def _met(rows: DataFrame, fit: DataFrame, how: str = "inner") -> DataFrame:
    """rows with the columns of fit of their group; each part of a group meets a copy of its own."""
    copies = fit.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(copies, ["grp", "salt"], how)


def _distance(rows: DataFrame, fit: DataFrame, how: str = "inner") -> DataFrame:
    """rows with d2, the squared Mahalanobis distance, by forward substitution with the Cholesky factor l of the covariance."""
    df = _met(rows, fit, how)
    for i in range(P):
        inner = F.col(STATISTICS[i]) - F.col(f"m{i}")
        for j in range(i):
            inner = inner - F.col(f"l{i}{j}") * F.col(f"z{j}")
        df = df.withColumn(f"z{i}", inner / F.col(f"l{i}{i}"))
    return df.withColumn("d2", sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, P)), F.col("z0") * F.col("z0")))


def _d2_bin(d2: Column) -> Column:
    """Bins a hundredth of a power of e wide, so that near distances are told apart as finely as far ones."""
    return F.floor(100 * F.log(d2 + 1e-4))


def _factored(sums: DataFrame) -> DataFrame:
    """(grp, start, m, l) from means d of differences to o, and means c of their products: centre and Cholesky factor."""
    df = sums
    for i, j in PAIRS:
        cov = F.col(f"c{i}{j}") - F.col(f"d{i}") * F.col(f"d{j}")
        if i == j:
            cov = F.greatest(cov, F.lit(0.0)) + FLOORS[i] ** 2 / 2
        for k in range(j):
            cov = cov - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        df = df.withColumn(f"l{i}{j}", F.sqrt(F.greatest(cov, F.lit(1e-9))) if i == j else cov / F.col(f"l{j}{j}"))
    return df.select("grp", "start", *((F.col(f"o{i}") + F.col(f"d{i}")).alias(f"m{i}") for i in range(P)), *(f"l{i}{j}" for i, j in PAIRS))


def _judged(fit: DataFrame, label: str = "mcd-step") -> DataFrame:
    """fit, stored, with the logarithm of each determinant. The factors are columns by then, not expressions within one another."""
    return stored(fit, label).withColumn("logdet", sum((2 * F.log(f"l{i}{i}") for i in range(1, P)), 2 * F.log("l00")))


def _moments(near: DataFrame, *keys: str) -> DataFrame:
    """Per keys the means of differences to the last centre m, which keeps the sums of products small, and of their products."""
    centred = lambda i: F.col(STATISTICS[i]) - F.col(f"m{i}")
    return near.groupBy(*keys).agg(
        *(F.max(f"m{i}").alias(f"o{i}") for i in range(P)), *(F.avg(centred(i)).alias(f"d{i}") for i in range(P)), *(F.avg(centred(i) * centred(j)).alias(f"c{i}{j}") for i, j in PAIRS))


def _starts(rows: DataFrame, subsets: int) -> DataFrame:
    """The starts of every group: 0 from medians, the others from the rows of one part each."""
    median = stored(_start(rows).withColumn("start", F.lit(0)), "mcd-start")
    part = F.pmod(F.xxhash64(*STATISTICS, F.lit("start")), F.lit(SALTS))
    chosen = _met(rows.withColumn("_part", part.cast("int")).where(F.col("_part") < subsets), median.drop("start"))
    sums = stored(_moments(chosen.withColumn("start", F.col("_part") + 1), "grp", "start"), "mcd-moments")
    return stored(median.unionByName(_factored(sums)), "mcd-starts")


def _concentrate(rows: DataFrame, fit: DataFrame, support: float) -> DataFrame:
    """One concentration step for each start: mean and Cholesky factor of the covariance of the nearest `support` share of each group."""
    placed = _distance(rows, fit).withColumn("bin", _d2_bin(F.col("d2")))
    limit = _binned_quantile(placed.groupBy("grp", "start", "bin").agg(F.count(F.lit(1)).alias("n")), ["grp", "start"], support)
    limited = fit.join(limit.select(F.col("grp").alias("_g"), F.col("start").alias("_s"), F.col("bin").alias("most")), (F.col("grp") == F.col("_g")) & (F.col("start") == F.col("_s"))).drop("_g", "_s")
    near = _distance(rows, limited).where(_d2_bin(F.col("d2")) <= F.col("most"))
    return _factored(stored(_moments(near, "grp", "start"), "mcd-moments"))


def covariances(rows: DataFrame, support: float = 0.75, subsets: int = 3, steps: int = 12, tolerance: float = 1e-3) -> DataFrame:
    """(grp, m, l, logdet): the estimate of every group of rows (grp, salt, x0..x4)."""
    fit = _starts(rows, subsets)
    for _ in range(2):
        fit = stored(_concentrate(rows, fit, support), "mcd-step")
    fit = _judged(fit)
    columns = [c for c in fit.columns if c != "grp"]
    best = fit.groupBy("grp").agg(F.min(F.struct("logdet", *(c for c in columns if c != "logdet"))).alias("f"))
    fit = stored(best.select("grp", *(F.col(f"f.{c}").alias(c) for c in columns)), "mcd-best")
    for _ in range(steps):
        after = _judged(_concentrate(rows, fit.drop("logdet"), support))
        fell = after.select("grp", F.col("logdet").alias("_new")).join(fit.select("grp", "logdet"), "grp").agg(F.max(F.col("logdet") - F.col("_new"))).first()[0]
        discard(fit)
        fit = after
        if fell is None or fell < tolerance:
            break
    return fit


def robust_outliers(docs: DataFrame, keys: tuple[str, ...] = ("lang", "source"), *, keep: tuple[str, ...] = ("doc_id",), support: float = 0.75,
                    limit: float = 140.0, least_rows: int = 200) -> DataFrame:
    """docs' `keep` columns with the base statistics, base_failed, d2 and kept; `limit` is the largest squared distance that is kept."""
    base = base_statistics(docs.select(*dict.fromkeys([*keep, *keys, "text"])))
    made = stored(vector(base.drop("text")).withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")), "rule-statistics")
    rows = stored(_grouped(made, list(keys), least_rows), "rule-groups")
    discard(made)
    # Documents that fail the base rule are rejected already; the estimates are of the others.
    fit = covariances(rows.where(~F.col("base_failed")).select("grp", "salt", *STATISTICS), support)
    bins = _distance(rows.where(~F.col("base_failed")), fit).groupBy("grp", _d2_bin(F.col("d2")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    scale = _binned_quantile(bins, ["grp"], 0.5).select(F.col("grp").alias("_g"), F.greatest(F.exp((F.col("bin") + 0.5) / 100) / CHI2_MEDIAN, F.lit(1.0)).alias("scale"))
    scaled = stored(fit.join(scale, F.col("grp") == F.col("_g")).drop("_g", "start", "logdet"), "mcd-scaled")
    out = _distance(rows, scaled, "left").withColumn("d2", F.col("d2") / F.col("scale"))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("d2"), F.lit(0.0)) <= limit)
    return out.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "d2", *STATISTICS)
