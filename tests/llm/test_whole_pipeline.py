"""The whole pipeline against a plain version of each stage."""

import hashlib
import random
from collections import Counter

import numpy as np

from ledgerloom.llm import langid, sentencepiece_codec
from ledgerloom.llm.queries import tokenizer_path

from .test_shingle_join import changed, kept_by_brute_force
from .test_text_operators import WORD, brute_targets, prose, slow_cut

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_run_equals_brute_force(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(12)
    passage = " ".join(f"tern{i % 7}heron{i}" for i in range(51))
    assert 256 <= len(passage.encode()) < 700
    texts = [prose(("en", "de")[i % 2], 300 + i, 60 + 9 * i) for i in range(26)]
    texts[3], texts[9] = f"{texts[3]} {passage} {texts[3][:40]}", f"{passage} {texts[9]}"
    rows = [(i, t, ("en", "de")[i % 2], "abc"[rng.randint(0, 2)], len(t)) for i, t in enumerate(texts)]
    rows += [(50, texts[4], "en", "a", 1), (51, changed(texts[20], 2, 3), "en", "b", 1), (52, None, "en", "a", 0), (53, "12 34", "de", "c", 5), (None, texts[25] + " keep", "de", "a", 1)]
    spark.createDataFrame(rows, DOC).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")

    # Language: the classifier itself is compared with plain compression elsewhere.
    clear = Counter((r["doc_id"], r["text"]) for r in langid.predict(docs, keep=("doc_id", "text"), least=corpus_pipeline.LEAST_LANGUAGE_SCORE).where("not rejected").collect())
    left = [r for r in rows if clear[r[0], r[1]]]
    assert {52, 53}.isdisjoint({r[0] for r in left}) and len(left) > 20
    # One of each group of near-duplicates.
    kept = kept_by_brute_force(left)
    left = [r for r in left if (str(r[0]), str(r[1])) in kept]
    assert {50, 51}.isdisjoint({r[0] for r in left})
    # Passages that stand elsewhere too.
    cut = []
    for r, (size, removed, _, digest) in zip(left, slow_cut([r[1] for r in left], corpus_pipeline.PASSAGE_BYTES), strict=True):
        text = r[1] if not removed else next(t for t in (r[1].replace(passage, ""), r[1].replace(f"{passage} ", ""), r[1].replace(f" {passage}", ""), r[1].replace(f" {passage} ", "")) if hashlib.sha256(t.encode()).hexdigest() == digest)
        if removed < size:
            cut.append((r[0], text, r[3]))
    assert not any(passage in t for _, t, _ in cut) and sum(t != dict((r[0], r[1]) for r in left)[i] for i, t, _ in cut) == 2
    # Copies by the tilted rates of each source.
    sizes = {s: np.array([len(WORD.findall(t)) for _, t, x in cut if x == s], float) for s in {x for *_, x in cut}}
    aims = brute_targets({s: int(v.sum()) for s, v in sizes.items()})
    tilts = {}
    for s, v in sizes.items():
        low, high = -1.0, 2.0
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if (v * np.minimum(3, np.exp(np.minimum(middle * v, 9)))).sum() < aims[s] else (low, middle)
        tilts[s] = low if aims[s] < 3 * v.sum() else np.inf
    codec = sentencepiece_codec.Codec(tokenizer_path())
    got = Counter((r["doc_id"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    want = {(i, tuple(codec.model.encode(t))): min(3.0, float(np.exp(min(9, tilts[s] * len(WORD.findall(t)))))) for i, t, s in cut}
    assert set(got) <= set(want)
    for key, rate in want.items():
        assert got[key] in (int(rate), int(rate) + 1) and got[key] <= 3, (key[0], got[key], rate)
    taken = Counter()
    for i, t, s in cut:
        taken[s] += got[i, tuple(codec.model.encode(t))] * len(WORD.findall(t))
    for s in aims:
        assert abs(taken[s] - aims[s]) <= max(sizes[s])
