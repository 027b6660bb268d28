import math
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import labels, learned, metrics, retrieval, scoring
from ledgerloom.plans import queries as plans

DATA = "/root/testdata/sf0.001"


def scored(spark, rows):
    return spark.createDataFrame(rows, "score double, label int")


def test_auc_and_precision(spark):
    assert metrics.roc_auc(scored(spark, [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)])).first()["auc"] == 0.75
    assert metrics.roc_auc(scored(spark, [(0.5, 0), (0.5, 1), (0.2, 0), (0.9, 1)])).first()["auc"] == 0.875
    assert metrics.roc_auc(scored(spark, [(0.5, 1)])).first()["auc"] == 0.5
    assert metrics.average_precision(scored(spark, [(0.9, 1), (0.8, 0), (0.7, 1)])).first()["ap"] == pytest.approx(5 / 6)
    assert metrics.average_precision(scored(spark, [(0.9, 0)])).first()["ap"] == 0.0
    sweep = {r["threshold"]: r for r in metrics.threshold_sweep(scored(spark, [(0.9, 1), (0.2, 0)])).collect()}
    assert len(sweep) == 21 and sweep[0.5]["f1"] == 1.0 and sweep[0.0]["precision"] == 0.5 and sweep[1.0]["recall"] == 0.0


def test_idf_counts_records_without_tokens(spark):
    df = spark.createDataFrame([(["a", "a", "b"],), (["a"],), ([],)], "tokens array<string>")
    got = {r["token"]: (r["df"], r["n"], r["idf"]) for r in retrieval.idf(df).collect()}
    assert got["a"] == (2, 3, pytest.approx(math.log(4 / 3) + 1)) and got["b"][0] == 1


def test_candidates_within_years(spark):
    q = spark.createDataFrame([(1, "title", "sea", 1950)], "query int, field string, token string, year int")
    index = spark.createDataFrame([("title", "sea", y, f"u{y}") for y in (1948, 1949, 1950, 1951, 1952)], "field string, token string, year int, uuid string")
    assert {r["uuid"] for r in retrieval.candidates(q, index, 1).collect()} == {"u1949", "u1950", "u1951"}
    assert {r["uuid"] for r in retrieval.candidates(q, index).collect()} == {"u1950"}


def test_candidate_counts_without_pairs(spark, tmp_path, monkeypatch):
    """Equal to counting the pairs, and what is joined does not grow with queries times keys."""
    rng = random.Random(5)
    q = spark.createDataFrame([(k, "title", t, rng.choice([None, 1950, 1951, 1953])) for k in range(60) for t in rng.sample("abcde", rng.randint(1, 3))], "query int, field string, token string, year int")
    index = spark.createDataFrame([("title", t, 1949 + u % 4, u) for u in range(200) for t in rng.sample("bcdef", rng.randint(1, 2)) * 2], "field string, token string, year int, uuid int")
    want = retrieval.candidates_around(q, index, F.col("year"), 1).groupBy("query").count()
    assert sorted(map(tuple, retrieval.candidate_counts(q, index, F.col("year"), 1).collect())) == sorted(map(tuple, want.collect()))
    made, plain = [], retrieval.candidates
    monkeypatch.setattr(retrieval, "candidates", lambda *a: made.append(plain(*a)) or made[-1])
    spark.range(20000).selectExpr("id as o_orderkey", "'1-URGENT' as o_orderpriority", "timestamp '1996-05-01' as o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(60).selectExpr("id as c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    rows = plans.QUERIES["candidates_explicit_year"](spark, str(tmp_path)).collect()
    assert {r["candidates"] for r in rows} == {30} and all(df.count() <= 6 for df in made)
    assert {r["o_orderkey"] for r in rows} == {k for k in range(20000) if k % 5}  # every order that has a year, not a share of them


def test_overlap_joins_no_tokens_of_records_by_pair(spark):
    """As counted by hand, also with a null key; the tokens of the records are laid out once, and nothing is joined by record."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(30)]
    records = {k: rng.sample(words[: rng.choice([3, 30])], 3) for k in range(80)}
    asked = {k: rng.sample(words + ["never"], 4) for k in range(9)}
    schema = "tokens array<string>"
    rows = spark.createDataFrame([*((k, v) for k, v in records.items()), (None, ["w0", "w29"]), (99, [])], f"doc int, {schema}")
    out = retrieval.weighted_overlap(spark.createDataFrame(list(asked.items()), f"item int, {schema}"), rows, "item", "doc", 0.2)
    n, every = 82, [*records.values(), ["w0", "w29"]]
    df = {w: sum(w in v for v in every) for w in words}
    weight = lambda w: math.log((n + 1) / (df[w] + 1)) + 1 if df.get(w) else math.log(n + 1) + 1
    want = {}
    for i, ask in asked.items():
        known = [w for w in ask if df.get(w)]
        rare = [w for w in known if df[w] <= 0.2 * n] or known
        for k, v in records.items():
            if set(rare) & set(v):
                both = set(ask) & set(v)
                want[i, k] = (sum(map(weight, both)), sum(map(weight, ask)), sum(map(weight, v)), len(both), max(map(weight, both)))
    got = {(r["item"], r["doc"]): (r["shared"], r["mass_a"], r["mass_b"], r["k"], r["best"]) for r in out.collect()}
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p]) for p in want)
    assert {(r["item"], r["doc"]) for r in retrieval.overlap_candidates(spark.createDataFrame(list(asked.items()), f"item int, {schema}"), rows, "item", "doc", 0.2).collect()} == set(want)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Join Inner" in line and "(doc#" in line for line in plan.splitlines())


def test_platt_values(spark):
    rows = spark.createDataFrame([(50.0, 0.4525), (60.0, 0.7630), (70.0, 0.9261), (80.0, 0.9799), (90.0, 0.9948)], "raw double, want double")
    for r in rows.withColumn("p", scoring.platt(F.col("raw"), -0.135969, 6.989077)).collect():
        assert r["p"] == pytest.approx(r["want"], abs=6e-4)


def test_platt_fit_separates(spark):
    rows = spark.createDataFrame([(float(x), int(x + (x * 7) % 5 > 50)) for x in range(100)], "raw double, label int")
    fit = learned.platt_fit(rows).first()
    assert fit["a"] < 0 and 30 < -fit["b"] / fit["a"] < 60


def test_volume_and_lccn(spark):
    df = spark.createDataFrame([("whole", "part", "1"), ("part", "part", "1"), ("unknown", "part", "1")], "ka string, kb string, p string")
    got = [tuple(r["e"])[:2] for r in df.select(scoring.volume_score(F.col("ka"), F.lit("1"), F.col("kb"), F.col("p"), F.lit(None)).alias("e")).collect()]
    assert got == [(0.0, False), (100.0, False), (0.0, True)]
    assert tuple(df.select(scoring.lccn_score(F.lit("1"), F.lit("2")).alias("e")).first()["e"]) == (0.0, True, False)


def test_upsert_and_migration(spark):
    old = spark.createDataFrame([("a", 1, 3)], "k string, v int, schema int")
    assert labels.upsert(old, old.withColumn("v", F.lit(2)), ["k"], ["v"]).collect()[0]["v"] == 2
    row = labels.migrate(old).first()
    assert row["schema"] == 8 and row["match_source"] == "registration" and row["categories"] == []


def test_reservoir_is_repeatable(spark):
    rows = spark.range(1000).withColumn("lang", (F.col("id") % 3).cast("string"))
    a, b = ({r["id"] for r in labels.reservoir(rows, ["lang"], "id", 10, 7).collect()} for _ in range(2))
    assert a == b and len(a) == 30


def test_feature_contract():
    with pytest.raises(learned.FeatureMismatch):
        learned.check_features(["a"], ["b"])


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, bool):
        return v
    return float(v) if isinstance(v, int) else str(v) if hasattr(v, "year") else v


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_query_equals_sql(spark, sql, name):
    df = plans.QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    cursor = sql.execute(f"select {', '.join(names)} from ({plans.ORACLE_SQL[name]}) q")
    want = sorted(repr(tuple(map(plain, r))) for r in cursor.fetchall())
    assert sorted(repr(tuple(plain(r[c]) for c in names)) for r in df.collect()) == want


def test_nearest_rank_without_a_sort(spark):
    import random

    rng = random.Random(2)
    values = [rng.random() ** 6 * 1e6 for _ in range(3000)] + [5.0] * 500 + [None]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    known = sorted(v for v in values if v is not None)
    for share in (0.0, 0.25, 0.5, 0.9, 1.0):
        assert metrics.nearest_rank(rows, "v", share, bins=16, few=40).first()["v"] == known[int(share * (len(known) - 1))]
    assert metrics.nearest_rank(rows.limit(0), "v", 0.5).count() == 0
    with pytest.raises(metrics.LabelError):
        metrics.check_labels(scored(spark, [(0.5, 2)]))


def test_overlap_of_frequent_and_rare_words(spark):
    docs = spark.createDataFrame([(i, ["the", f"w{i}"] + (["rare"] if i < 2 else [])) for i in range(20)], "doc_id int, tokens array<string>")
    items = spark.createDataFrame([(1, ["the", "rare"]), (2, ["the"]), (3, ["new"])], "item_id int, tokens array<string>")
    got = {(r["item_id"], r["doc_id"]): r for r in retrieval.weighted_overlap(items, docs, "item_id", "doc_id", 0.2).collect()}
    assert {k for k in got if k[0] == 1} == {(1, 0), (1, 1)} and len([k for k in got if k[0] == 2]) == 20 and not [k for k in got if k[0] == 3]
    idf = lambda df: math.log(21 / (df + 1)) + 1
    row = got[1, 0]
    assert row["k"] == 2 and row["shared"] == pytest.approx(idf(20) + idf(2)) and row["mass_b"] == pytest.approx(idf(20) + idf(2) + idf(1)) and row["best"] == pytest.approx(idf(2))
    assert retrieval.point_lookup(items.limit(1), items, "item_id").count() == 1


def test_budget_selection_and_queue(spark):
    table = labels.budget_table(spark)
    assert table.count() == 25 and table.agg(F.sum("cap")).first()[0] == 2320
    assert labels.budget_table(spark, 232).agg(F.min("cap")).first()[0] >= 1
    with pytest.raises(ValueError):
        labels.budget_table(spark, 0)
    targets = {r["language"]: r["target"] for r in labels.language_targets(spark, 100).collect()}
    assert targets == {"eng": 70, "fre": 8, "ger": 8, "ita": 8, "spa": 8}
    records = spark.createDataFrame([(str(i), "eng", 1950 if i % 5 else None) for i in range(100)], "control_id string, language string, publication_year int")
    known = records.where("control_id < '2'").select("control_id")
    aims = spark.createDataFrame([("eng", 10), ("fre", 3)], "language string, target int")
    drawn = labels.selected_records(records, known, aims)
    assert drawn.count() == 10 and drawn.join(known, "control_id").count() == 0 and drawn.where("publication_year is null").count() == 0
    plan = {r["language"]: r.asDict() for r in labels.selection_plan(records, known, aims).collect()}
    assert plan["eng"]["selected"] == 10 and plan["fre"]["selected"] == 0 and plan["eng"]["excluded"] == known.count()
    pairs = spark.createDataFrame([("m", f"u{i}", "eng", i / 100, i) for i in range(100)], "control_id string, uuid string, language string, calibrated double, seq int")
    done = spark.createDataFrame([("m", "u99")], "marc_control_id string, nypl_uuid string")
    caps = spark.createDataFrame([("eng", "ge90", 3), ("eng", "below", 4)], "language string, band string, cap int")
    queue = labels.build_queue(pairs, done, caps)
    assert sorted(r["uuid"] for r in queue.where("band = 'ge90'").collect()) == ["u90", "u91", "u92"] and queue.where("band = 'below'").count() == 4


def test_label_views(spark):
    vault = spark.createDataFrame([("m1", "u1", "match", "registration", ["a"], "Sea"), ("m1", "u2", "match", "registration", ["b"], "sky"), ("m2", "u3", "unsure", None, None, "SEA"), ("m3", "u1", "match", "renewal", ["a", "b"], None)],
                                  "marc_control_id string, nypl_uuid string, verdict string, match_source string, categories array<string>, title string")
    assert labels.gold_labels(vault).count() == 2
    assert labels.truth_of(labels.gold_labels(vault), "nypl_uuid").first()["nypl_uuid"] == "u2"
    assert labels.listed(vault, contains="sea", fields=("title",)).count() == 2 and labels.listed(vault, verdict="match", categories=("b",)).count() == 2
    kept, dropped = labels.requeued(vault, ("unsure",))
    assert kept.count() == 3 and dropped.first()["n"] == 1
    picks = spark.createDataFrame([("m", "b", 0.5, 0.9), ("m", "a", 0.5, 0.2)], "k string, u string, x double, y double")
    row = labels.dual_scores(picks, "k", "u", "x", "y").first()
    assert (row["x_pick"], row["y_pick"], row["bucket"]) == ("a", "b", "informative") and row["gap"] == pytest.approx(1.4)
    stats = {r["bucket"]: r["n"] for r in labels.bucket_statistics(labels.dual_scores(picks, "k", "u", "x", "y")).collect()}
    assert stats == {"informative": 1, "agree_high": 0, "agree_low": 0}
    marc, cce = spark.createDataFrame([("m1",), ("m2",)], "control_id string"), spark.createDataFrame([("u1", "A1", 1950, True, "R", None)], "uuid string, regnum string, reg_year int, was_renewed boolean, renewal_id string, renewal_date date")
    found, counts = labels.resolved(vault, marc, cce)
    assert found.count() == 1 and counts.first().asDict() == {"pairs": 4, "no_marc": 1, "no_cce": 2, "resolved": 1}
    scores = spark.createDataFrame([("m1", "u1", 0.123456, None)], "marc_control_id string, nypl_uuid string, weighted_mean double, learned double")
    assert labels.enriched(vault, cce, scores, "v").where("marc_control_id = 'm1' and nypl_uuid = 'u1'").first()["scores"]["weighted_mean"] == 0.1235


def test_out_of_fold_and_artefacts(spark, tmp_path):
    rows = spark.createDataFrame([(i // 2, float(i % 7), float(i % 3), int(i % 7 > 3)) for i in range(120)], "k int, x double, y double, label int")
    options = {"trees": 3, "depth": 2}
    held = learned.out_of_fold(rows, ["x", "y"], "k", 3, **options)
    assert held.count() == 120 and learned.cross_validated(rows, ["x", "y"], "k", 3, **options).first()["auc"] > 0.95
    model = learned.train(rows, ["x", "y"], **options)
    assert {r["feature"]: r["importance"] for r in learned.importance(model, ["x", "y"]).collect()}["x"] > 0.9
    learned.save(model, str(tmp_path / "m"))
    again = learned.load(spark, str(tmp_path / "m"), ["x", "y"])
    assert learned.predict(again, rows, ["x", "y"]).count() == 120
    with pytest.raises(learned.FeatureMismatch):
        learned.load(spark, str(tmp_path / "m"), ["y", "x"])
    renewals = spark.createDataFrame([(str(i), *(float((i * j) % 5) for j in range(1, 8)), None, i % 2) for i in range(60)], "k string, " + ", ".join(f"{c} double" for c in learned.RENEWAL_FEATURES) + ", label int")
    assert learned.renewal_matcher(renewals, "k", wide=True, folds=2).where("score between 0 and 1").count() == 60


def test_join_measurements(spark):
    from ledgerloom.operators import renewal

    schema = "id string, raw string, norm string, day string, year int"
    regs = spark.createDataFrame([("a", "A-1", "A1", "1950-01-01", 1950), ("b", "A 1", "A1", None, 1951)], schema)
    rens = spark.createDataFrame([("r", "A1", "A1", "1950-02-01", 1950), ("s", "A-1", "A1", "1950-01-01", 1950)], schema)
    got = {r["scheme"]: (r["joined"], r["single"]) for r in renewal.joined_by_scheme(regs, rens).collect()}
    assert got == {"raw_day": (1, 1), "norm_day": (1, 1), "norm_year": (2, 2), "norm": (2, 0)}
    numbers = spark.createDataFrame([("A foreign 12",), ("AF12",), ("A1 A2",)], "n string")
    assert {(r["class"], r["folded"]) for r in renewal.class_folds(numbers, "n").collect()} == {("AFOREIGN", "AF"), ("AF", "AF"), ("A", "A")}
    assert [tuple(r) for r in renewal.range_sizes(numbers, "n").collect()] == [(2, 1)]


def test_streams_report_and_stop(spark, tmp_path):
    from ledgerloom.streaming import upserts

    spark.createDataFrame([(i, i % 5) for i in range(40)], "i int, k int").repartition(4).write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(99, 99)], "i int, k int").write.parquet(str(tmp_path / "t.old"))
    got = upserts.latest_of_files(spark, str(tmp_path / "t"), ["k"], ["i"], parts=3)
    assert sorted((r["k"], r["i"]) for r in got.collect()) == [(k, 35 + k) for k in range(5)]
    watch = upserts.Progress(stall=2)
    spark.streams.addListener(watch)
    query = spark.readStream.schema("i int, k int").parquet(str(tmp_path / "t")).writeStream.format("noop").start()
    query.processAllAvailable()
    assert upserts.stop_gracefully(query)
    import time

    for _ in range(50):
        if watch.ended:
            break
        time.sleep(0.1)
    spark.streams.removeListener(watch)
    assert watch.rows == 40 and not watch.stalled and watch.ended
    lines = spark.createDataFrame([('{"a": 1}',), ("{bad",), ('{"a": 2}',)], "value string")
    good, seen = upserts.counted_records(lines, "a int")
    assert good.count() == 2 and seen.get == {"kept": 2, "skipped": 1}


def test_stop_gracefully_looks_once():
    from ledgerloom.streaming import upserts

    class Query:
        isActive = True

        def __init__(self, *active):
            self.active, self.stopped = list(active), 0

        @property
        def status(self):
            return {"isTriggerActive": self.active.pop(0) if len(self.active) > 1 else self.active[0]}

        def stop(self):
            self.stopped += 1

    polls, busy = Query(True, False, True), Query(True)  # idle once and then polling its source; a batch that never ends
    assert upserts.stop_gracefully(polls, 5) and polls.stopped == 1
    assert not upserts.stop_gracefully(busy, 0.3) and busy.stopped == 1


def test_relative_times(spark):
    from ledgerloom.functions import identifiers, text

    rows = spark.createDataFrame([(s,) for s in ("2026-01-01 11:59:30", "2026-01-01 11:57:00", "2026-01-01 07:00:00", "2025-12-30 12:00:00", "2025-12-01 12:00:00")], "t string")
    got = [r[0] for r in rows.select(text.relative_time(F.col("t").cast("timestamp"), F.lit("2026-01-01 12:00:00").cast("timestamp"))).collect()]
    assert got == ["just now", "3m ago", "5h ago", "2d ago", "4w ago"]
    assert rows.select(identifiers.lccn_url(F.lit("50001234")), identifiers.oclc_url(F.lit(""))).first()[1] is None


def test_platt_fit_reads_its_rows_once(spark):
    read = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda x: read.add(1) or x, "double").asNondeterministic()
    rows = spark.createDataFrame([(float(x), int(x + (x * 7) % 5 > 50)) for x in range(100)] * 2, "raw double, label int")
    fit = learned.platt_fit(rows.withColumn("raw", seen("raw"))).first()
    assert read.value == 200 and fit["a"] < 0
