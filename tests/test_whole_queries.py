import random

from ledgerloom.operators import similarity
from ledgerloom.plans import queries


def test_name_scores_cover_all_customers(spark, tmp_path):
    spark.createDataFrame([(0, "FRANCE"), (1, "PERU")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(i, f"Customer#{i}", i % 2) for i in range(1, 21)], "c_custkey bigint, c_name string, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(i, f"Supplier#{i}", i % 2) for i in range(1, 5)], "s_suppkey bigint, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    for name in ("author_score", "publisher_score"):
        rows = queries.QUERIES[name](spark, str(tmp_path)).collect()
        assert sorted((r["c_custkey"], r["s_suppkey"]) for r in rows) == [(c, s) for c in range(1, 21) for s in range(1, 5) if c % 2 == s % 2]
        assert all(r["score"] > 0 for r in rows)


def test_best_window_equals_all_windows():
    rng = random.Random(4)
    vocabulary = [rng.choice(["harbor", "harbour", "garden", "gardens", "river", "rivers", "stone", "winter"]) + rng.choice(["", "s", "y", "ing"]) for _ in range(40)]
    for _ in range(60):
        short, long_ = [rng.choice(vocabulary) for _ in range(rng.randint(1, 6))], [rng.choice(vocabulary) for _ in range(40)]
        idf = {w: rng.uniform(1, 9) for w in vocabulary[::2]}
        n = len(short)
        want = max(similarity._masses(set(short), set(long_[i : i + n]), idf, 10.0) for i in range(len(long_) - n + 1))
        assert abs(similarity.best_window(short, long_, idf, 10.0) - want) < 1e-9


def test_exact_windows_equal_one_by_one():
    rng = random.Random(6)
    for _ in range(80):
        words = [rng.choice("abcdefghijklmnop") for _ in range(rng.randint(0, 40))]
        others = [[rng.choice("abcdefghijklmnopqrstuvw") for _ in range(rng.randint(0, 25))] for _ in range(8)]
        assert similarity.exact_windows(words, others) == [similarity.exact_window(o, words) for o in others]


def test_sliding_window_has_no_text_in_a_pair(spark, tmp_path):
    """No join by passage or pair has the words of a document beside it."""
    spark.createDataFrame([(i, f"alpha{i} beta{i} gamma") for i in range(5)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(5, "en", "x alpha1 beta1 gamma y z alpha2 q r"), (6, "en", "alpha3 alpha4")], "doc_id bigint, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = queries.QUERIES["title_sliding_window"](spark, str(tmp_path))
    assert sorted(map(tuple, df.collect())) == [(0, 5, 20.0), (1, 5, 100.0), (2, 5, 20.0), (3, 5, 20.0), (4, 5, 20.0)]
    sorts = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(item_id" in line]
    assert not any("doc_id" in line and "text" in line for line in sorts)


def test_fuzzy_title_score_reads_words_after_the_twelfth(spark, tmp_path, monkeypatch):
    passage = " ".join(f"passage{i}" for i in range(14))
    filler = " ".join(f"filler{i}" for i in range(20))
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(5, f"{filler} {passage}")], "doc_id bigint, text string").withColumns({"lang": queries.F.lit("en")}).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "_top", lambda spark, d: spark.createDataFrame([(1, 5)], "item_id bigint, doc_id bigint"))
    assert queries.fuzzy_title_score(spark, str(tmp_path)).first()["score"] > 40  # whole lists: 14 shared of 34 words


def test_entry_without_the_corpus_part(tmp_path):
    """With both corpus folders gone the entry points still offer all other queries; a missing library is not passed over."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "ledgerloom", tmp_path / "ledgerloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    run = lambda code: subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    out = run("import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op1_') for n in q), set(e.oracle_sql()) <= set(q))")
    assert out.stdout.split() == [str(len(queries.QUERIES)), "False", "True"], out.stderr
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_library\n")
    assert "no_such_library" in run("import __spark_entry__").stderr
