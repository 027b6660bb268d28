import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import shingle_join

from .conftest import DOC, invented


def changed(text, n, seed):
    words, rng = text.split(), random.Random(seed)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"new{seed}x{i}"
    return " ".join(words)


def kept_by_brute_force(rows):
    """(doc_id, text) of the row kept of each component of pairs with five-word Jaccard 0.8 or more."""
    sets = [set(shingle_join.shingles((r[1] or "").encode(), 5).tolist()) for r in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    groups = {}
    for r, row in zip(root, rows, strict=True):
        groups.setdefault(r, []).append((row[0] is None, row[0], row[1]))
    return sorted((str(g[1]), str(g[2])) for g in (min(x, key=lambda y: (y[0], y[1] or 0)) for x in groups.values()))


@pytest.mark.parametrize("list_most", [64, 3])
def test_pairs_from_four_fifths_on_are_found(spark, monkeypatch, list_most):
    monkeypatch.setattr(shingle_join, "LIST_MOST", list_most)
    monkeypatch.setattr(shingle_join, "PIVOTS", 1)
    rows, base = [], [invented(700 + i, 300) for i in range(12)]
    for i, text in enumerate(base):
        rows += [(10 * i + j, changed(text, 2 * j, 50 * i + j), "en", "a", 1) for j in range(6)]
    chain = [base[0]]
    for j in range(8):  # each like the one before, the ends unlike
        chain.append(changed(chain[-1], 5, 900 + j))
    rows += [(500 + j, t, "en", "a", 1) for j, t in enumerate(chain)] + [(900 + i, "a b c d e f g h i"[: 2 * i + 1], "en", "a", 1) for i in range(9)]
    rows += [(800, None, "en", "a", 1), (801, "", "en", "a", 1)]
    got = shingle_join.one_of_each(spark.createDataFrame(rows, DOC)).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in got) == kept_by_brute_force(rows)


def test_stage_drops_near_copies_of_many_differing_bits(spark):
    import corpus_pipeline

    text = invented(3, 400)
    docs = spark.createDataFrame([(1, text, "en", "a", 1), (2, changed(text, 8, 5), "en", "a", 1), (3, invented(4, 400), "en", "a", 1)], DOC)
    assert sorted(r["doc_id"] for r in corpus_pipeline.simhash_near_dedup(spark, docs, "").collect()) == [1, 3]


def test_rows_that_share_an_id_or_have_none(spark):
    import corpus_pipeline

    texts = [invented(20 + i, 100) for i in range(6)]
    rows = [(None, texts[0], "en", "a", 1), (None, texts[1], "en", "a", 1), (7, texts[2], "en", "a", 1), (7, texts[3], "en", "a", 1), (8, texts[4], "en", "a", 1), (8, texts[4], "en", "a", 1)]
    docs = spark.createDataFrame(rows, DOC)
    assert sorted(r["text"] for r in corpus_pipeline.simhash_near_dedup(spark, docs, "").collect()) == sorted(texts[:5])
    got = corpus_pipeline.mix_to_weights(spark, docs, "").groupBy("text").count().collect()
    assert {r["text"]: r["count"] for r in got} == dict.fromkeys(texts[:4], 1) | {texts[4]: 2}


def test_phrases_of_few_texts_bring_no_whole_sets_together(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "LIST_MOST", 4)
    monkeypatch.setattr(shingle_join, "SAMPLE", 20)
    sets = []
    monkeypatch.setattr(shingle_join, "_whole", lambda nodes, *a, f=shingle_join._whole: sets.append(nodes.distinct().count()) or f(nodes, *a))
    rows = [(i, f"{invented(3000 + i, 30)} {invented(60 + i % 37, 8)} {invented(9000 + i, 30)}", "en", "a", 1) for i in range(1500)]
    assert shingle_join.one_of_each(spark.createDataFrame(rows, DOC)).count() == 1500
    assert sum(sets) < 400  # some 40 texts have each phrase


def test_long_lists_in_portions(spark, monkeypatch):
    for name, value in (("LIST_MOST", 3), ("PIVOTS", 1), ("PORTION_SHARE", 0), ("PORTION_LEAST", 20_000)):
        monkeypatch.setattr(shingle_join, name, value)
    tables = []
    monkeypatch.setattr(shingle_join, "_compared", lambda *a, f=shingle_join._compared: tables.append(f(*a)) or tables[-1])
    rows = [(10 * i + j, changed(invented(700 + i % 3, 200), 5 * j, 50 * i + j), "en", "a", 1) for i in range(9) for j in range(6)]
    got = shingle_join.one_of_each(spark.createDataFrame(rows, DOC)).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in got) == kept_by_brute_force(rows)
    assert len(tables[0]) > 1


def test_near_copies_are_found_by_fingerprints(spark, monkeypatch):
    import corpus_pipeline
    from ledgerloom.llm import simhash

    monkeypatch.setattr(shingle_join, "bounded", lambda pairs, sizes: pairs.select("a", "b").limit(0))  # nothing from the index of shingles
    text = invented(3, 3000)
    near = changed(text, 1, 5)
    a, b = (simhash.fingerprint_of_hashes(shingle_join.shingles(t.encode(), 5)) for t in (text, near))
    assert 0 < (a ^ b).bit_count() <= 3
    rows = [(1, text, "en", "a", 1), (2, near, "en", "a", 1), (3, invented(4, 3000), "en", "a", 1), (4, text.upper(), "en", "a", 1)]
    assert sorted(r["doc_id"] for r in corpus_pipeline.simhash_near_dedup(spark, spark.createDataFrame(rows, DOC), "").collect()) == [1, 3]


def test_candidates_by_fingerprint_are_verified(spark, monkeypatch):
    from ledgerloom.llm import simhash

    every = lambda d: d.select(F.col("rep").alias("a")).crossJoin(d.select(F.col("rep").alias("b"))).where("a < b")
    monkeypatch.setattr(simhash, "link", every)
    rows = [(10 * i + j, changed(invented(700 + i, 200), 3 * j, 50 * i + j), "en", "a", 1) for i in range(4) for j in range(5)]
    got = shingle_join.one_of_each(spark.createDataFrame(rows, DOC)).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in got) == kept_by_brute_force(rows)


def test_fingerprints_of_hashes_equal_those_of_texts():
    from ledgerloom.llm import simhash

    for text in ("", "one", "a b c d e f g", invented(8, 700)):  # no shingle twice
        assert simhash.fingerprint_of_hashes(shingle_join.shingles(text.encode(), 5)) == simhash.fingerprint(text.encode(), 5)
