import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import langid, quality_fm, quality_rules, sentencepiece_codec, simhash, suffix_dedup, toxicity
from ledgerloom.llm.mixing import mix_sources
from ledgerloom.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_row(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# Mixing ---------------------------------------------------------------------------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    left, fixed = dict(sizes), {}
    while True:
        rest, mass = sum(sizes.values()) - sum(fixed.values()), sum(w[s] for s in left)
        over = [s for s in left if mass and rest * w[s] / mass > most * sizes[s]]
        if not over:
            return fixed | {s: rest * w[s] / mass for s in left}
        for s in over:
            fixed[s] = most * left.pop(s)


def test_mix_reaches_targets(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("w" * rng.randint(1, 400)), "en", rng.choice(["big"] * 8 + ["mid", "small", "x", None]), 0) for i in range(3000)]
    rows = [(i, t.replace("w", "w "), *r) for i, t, *r in rows]
    got = mix_sources(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1]))
    want, taken = brute_targets(sizes), Counter()
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.02 * want[s] + 20


def test_rates_solve_the_dual(spark):
    """The rates equal those of a plain bisection in numpy, differ within a source, and meet the token constraints."""
    rng = random.Random(9)
    rows = [(i, "w " * (rng.randint(1, 60) if i % 7 else rng.randint(500, 4000)), rng.choice("aaaaaabbc")) for i in range(400)]
    got = mix_sources(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    for source in "abc":
        own = [r for r in got if r["source"] == source]
        sizes, target = np.array([r["size"] for r in own], float), own[0]["target"]
        low, high = -1.0, 2.0
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if (sizes * np.minimum(3, np.exp(np.minimum(middle * sizes, 9)))).sum() < target else (low, middle)
        capped = target >= 3 * sizes.sum()
        want = np.full(len(sizes), 3.0) if capped else np.minimum(3, np.exp(np.minimum(low * sizes, 9)))
        assert np.allclose([r["rate"] for r in own], want, rtol=1e-9, atol=1e-12)
        assert sum(r["rate"] * r["size"] for r in own) == pytest.approx(target, rel=1e-9) and all(r["copies"] in (int(r["rate"]), int(r["rate"]) + 1) and r["copies"] <= 3 for r in own)
        assert capped or len({r["rate"] for r in own}) > 20


def test_mix_odd_rows(spark, odd, odd_rows, empty, clashing):
    got = mix_sources(odd)
    assert got.count() == len(odd_rows)
    assert by_row(got, "doc_id", "size") == Counter((r[0], len(WORD.findall(r[1] or ""))) for r in odd_rows)
    assert mix_sources(empty).count() == 0
    assert by_row(mix_sources(clashing), "doc_id", "taken") == by_row(got, "doc_id", "taken")


# SentencePiece --------------------------------------------------------------------------------------------------------------------


def test_sentencepiece_is_exact(odd, odd_rows, empty, clashing):
    codec = sentencepiece_codec.Codec(tokenizer_path())
    want = Counter()
    for doc_id, text, *_ in odd_rows:
        ids = codec.model.encode(text or "")
        want[(doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(codec.model.decode(ids).encode()).hexdigest())] += 1
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert by_row(sentencepiece_codec.digests(odd, tokenizer_path()), *columns) == want
    assert by_row(sentencepiece_codec.digests(clashing, tokenizer_path()), *columns) == want
    assert sentencepiece_codec.digests(empty, tokenizer_path()).count() == 0
    encoded = sentencepiece_codec.encode(odd, tokenizer_path())
    assert by_row(sentencepiece_codec.decode(encoded, tokenizer_path()), "doc_id", "text") == Counter((r[0], codec.model.decode(codec.model.encode(r[1] or ""))) for r in odd_rows)


def test_random_texts_are_segmented_alike(monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "TABLE_WORDS", 50)
    codec, rng = sentencepiece_codec.Codec(tokenizer_path()), random.Random(2)
    for _ in range(50):
        texts = ["".join(rng.choice(" ▁ab\né\n😀<s>\x00　") for _ in range(rng.randint(0, 40))) for _ in range(20)]
        assert codec.encode(texts)[0] == codec.model.encode(texts)


# SimHash --------------------------------------------------------------------------------------------------------------------------


def slow_fingerprint(text, width=3):
    import xxhash

    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, links):
    least = dict(zip(ids, ids, strict=True))
    while True:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            if least[a] != low or least[b] != low:
                least[a] = least[b] = low
                changed = True
        if not changed:
            return least


def test_simhash_odd_rows(odd, odd_rows, empty, clashing):
    got = simhash.near_duplicates(odd)
    prints = {id(r): slow_fingerprint(r[1]) for r in odd_rows}
    ids = sorted({r[0] for r in odd_rows if r[0] is not None})
    links = [(a[0], b[0]) for a in odd_rows for b in odd_rows if a[0] is not None and b[0] is not None and (prints[id(a)] ^ prints[id(b)]).bit_count() <= 3]
    least = groups(ids, links)
    rows = [r for r in got.collect() if r["doc_id"] is not None]
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows) == Counter((r[0], f"{prints[id(r)]:016x}", least[r[0]]) for r in odd_rows if r[0] is not None)
    assert simhash.near_duplicates(empty).count() == 0
    assert by_row(simhash.near_duplicates(clashing), "doc_id", "component_id") == by_row(got, "doc_id", "component_id")


def test_links_of_dense_lists_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LIST_MOST", 8)
    rng = random.Random(9)
    fps = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice((1, 3, 60))):
            x = centre
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash._signed(f), i) for i, f in enumerate(fps)], "fp bigint, rep bigint")
    from ledgerloom.llm.components import components

    want = groups(range(len(fps)), [(i, j) for i, a in enumerate(fps) for j, b in enumerate(fps) if i < j and (a ^ b).bit_count() <= 3])
    got = {r["node"]: r["component"] for r in components(simhash.link(df)).collect()}
    assert {i: got.get(i, i) for i in range(len(fps))} == want


def test_flipping_equals_comparing():
    rng = np.random.default_rng(3)
    base = np.uint64(0x1234567890ABCDEF)
    fps = np.unique(base ^ rng.integers(0, 1 << 24, 1500, dtype=np.uint64))
    positions = (3, 4, 5, 6, 7)
    link = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    want = groups(range(len(fps)), list(zip(*np.nonzero(link), strict=True)))
    assert simhash._roots(fps, positions).tolist() == [want[i] for i in range(len(fps))]


# Repeated passages ----------------------------------------------------------------------------------------------------------------


def slow_cut(texts, length=400):
    raws = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + length] for b in raws for i in range(len(b) - length + 1))
    out = []
    for b in raws:
        cover = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                cover[i : i + length] = b"\1" * length
        rest = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        out.append((len(b), sum(cover), sum(1 for i in range(len(b)) if cover[i] and (not i or not cover[i - 1])), hashlib.sha256(rest).hexdigest()))
    return out


CUT = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_cut_odd_rows(odd, odd_rows, empty, clashing):
    rows = [r if len(r[1] or "") < 50_000 else (r[0], r[1][:20_000], *r[2:]) for r in odd_rows]
    df = odd.sparkSession.createDataFrame(rows, odd.schema)
    want = Counter((r[0], *x) for r, x in zip(rows, slow_cut([r[1] for r in rows]), strict=True))
    assert by_row(suffix_dedup.apply(df), "doc_id", *CUT) == want
    assert suffix_dedup.apply(empty).count() == 0
    assert suffix_dedup.apply(clashing).count() == len(odd_rows)


def test_cut_passages(spark):
    from .conftest import invented

    rng, shared = random.Random(8), [invented(i, 100) for i in range(3)]
    texts = ["lol " * 300, "ab" * 450, "xab" * 300]
    for i in range(40):
        t = invented(900 + i, rng.randint(5, 150))
        for _ in range(rng.randint(0, 3)):
            p, a = rng.choice(shared), rng.randint(0, 200)
            at = rng.randint(0, len(t))
            t = t[:at] + p[a : a + rng.randint(380, 900)] + t[at:]
        texts.append(t)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for length, hot in ((400, 1024), (400, 2), (256, 1024), (256, 1)):  # lists within a task, and dealt out by windows
        got = {r["doc_id"]: tuple(r[c] for c in CUT) for r in suffix_dedup.apply(df, length=length, hot=hot).collect()}
        assert [got[i] for i in range(len(texts))] == slow_cut(texts, length), (length, hot)
    groups = defaultdict(list)
    for r in suffix_dedup.repeat_groups(df).collect():
        groups[r["h"], r["g"], r["left"] + r["right"]].append((bytes(r["key"]), r["place"]))
    by_key = {hashlib.md5(t.encode()).digest(): t.encode() for t in texts}
    for (_, _, n), places in groups.items():
        assert n >= 400 and len(set(places)) == len(places) > 1 and len({by_key[k][at : at + n] for k, at in places}) == 1
    cover = {k: bytearray(len(b)) for k, b in by_key.items()}
    for (_, _, n), places in groups.items():
        for k, at in places:
            cover[k][at : at + n] = b"\1" * n
    assert [sum(cover[hashlib.md5(t.encode()).digest()]) for t in texts] == [x[1] for x in slow_cut(texts)]


def test_maximal_repeats_equal_brute_force():
    rng, length = random.Random(3), 4
    for _ in range(200):
        members = list({("".join(rng.choice("ab") for _ in range(rng.randint(0, 5))).encode(), "".join(rng.choice("ab") for _ in range(rng.randint(1, 6))).encode()) for _ in range(7)})
        want = set()
        for a in range(len(members)):
            for b in range(a):
                left, right = (suffix_dedup._common(members[a][s], members[b][s]) for s in (0, 1))
                if left + right >= length:
                    same = [i for i, m in enumerate(members) if m[0][:left] == members[a][0][:left] and m[1][:right] == members[a][1][:right] and len(m[0]) >= left and len(m[1]) >= right]
                    want.add((left, right, tuple(same)))
        got = [(left, right, tuple(sorted(g))) for left, right, g in suffix_dedup.maximal_repeats(members, length)]
        assert want <= set(got) and len(set(got)) == len(got)
        for left, right, g in got:  # all members with these bytes, and diverse on both sides
            common = lambda side: min(suffix_dedup._common(members[x][side], members[y][side]) for x in g for y in g if x != y)  # noqa: B023, E731
            assert (common(0), common(1)) == (left, right) and left + right >= length


def test_intervals():
    assert sorted(suffix_dedup.intervals([2, 5, 5, 1])) == [(1, 0, 4), (2, 0, 3), (5, 1, 3)]


# Classifiers ----------------------------------------------------------------------------------------------------------------------


def prose(lang, seed, n):
    letters = {"en": "the and of to ing tion er".split(), "de": "der die und ung keit sch ein".split()}[lang]
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_language(spark, odd, empty, clashing):
    rows = [(i, prose(("en", "de")[i % 2], i, 30 + i % 90), ("en", "de")[i % 2]) for i in range(300)]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) / len(rows) > 0.98
    by = {r["doc_id"]: r for r in langid.predict(odd).collect()}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 and by[i]["rejected"] for i in (1, 2, 3, 10))
    assert by[4]["lang_pred"] in {"en", "fr", "de", "es"}
    assert langid.predict(empty).count() == 0 and langid.predict(clashing).count() == odd.count()
    assert {r["lang_pred"] for r in langid.predict(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


@pytest.fixture(scope="module")
def labelled(spark):
    rng, rows = random.Random(5), []
    for i in range(900):
        bad, toxic = i % 4 == 0, i % 5 == 1
        words = prose("en", i, 60).split()
        if bad:
            words = [w.upper() + "!!" if i % 8 else w + "***" for w in words]
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(("scumbag", "nitwit,", "Scumbag")))
        rows.append((i, " ".join(words), "en", "s", 100, int(not bad), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, quality int, toxic int")
    return df.drop("quality", "toxic"), df.select("doc_id", "quality", "toxic")


def accuracy(scores, labels, column):
    want = {r["doc_id"]: r[column] for r in labels.collect()}
    held = [r for r in scores.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0).collect()]
    return sum((r["score"] >= 0.5) == want[r["doc_id"]] for r in held) / len(held)


def test_quality_learns(labelled, odd, empty, clashing):
    docs, marks = labelled
    assert accuracy(quality_fm.predict(docs, marks), marks, "quality") > 0.97
    for df in (odd, clashing):
        scores = [r["score"] for r in quality_fm.predict(df, marks).collect()]
        assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    assert quality_fm.predict(empty, marks).count() == 0
    assert {r["score"] for r in quality_fm.predict(odd, marks.limit(0)).collect()} == {0.5}


def test_toxicity_learns(labelled, odd, empty, clashing):
    docs, marks = labelled
    assert accuracy(toxicity.predict(docs, marks), marks, "toxic") > 0.95
    for df in (odd, clashing):
        scores = [r["score"] for r in toxicity.predict(df, marks).collect()]
        assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    assert toxicity.predict(empty, marks).count() == 0
    assert {r["score"] for r in toxicity.predict(odd, marks.limit(0)).collect()} == {0.0}


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    machine = quality_fm.FactorisationMachine(quality_fm.Vocabulary(np.arange(9)), rank=3)
    known, stats = len(machine.vocabulary), 4
    machine.w0, machine.w, machine.v = 0.3, rng.normal(size=known + stats), rng.normal(size=(known + stats, 3))
    row, value, x = np.array([1, 4, 7]), rng.normal(size=3), rng.normal(size=(1, stats))
    at, val = np.concatenate([row, np.arange(known, known + stats)]), np.concatenate([value, x[0]])
    pairs = sum(machine.v[at[i]] @ machine.v[at[j]] * val[i] * val[j] for i in range(len(at)) for j in range(i))
    assert machine._raw(np.zeros(3, int), row, value, x)[0] == pytest.approx(0.3 + machine.w[at] @ val + pairs)


# Quality rules --------------------------------------------------------------------------------------------------------------------


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice, cover = Counter(windows), set()
    for i, w in enumerate(windows):
        if twice[w] > 1:
            cover |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover))


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_rule_statistics(spark, odd, odd_rows, empty, clashing):
    extra = [(200, "a b c a b c\na b c\na b c d", "en", "a", 1), (201, "one two\x0bthree\x1cfour\n\n\n# $ <x>", "en", "a", 1), (202, "w w w w w", None, None, None)]
    df = odd.unionByName(spark.createDataFrame(extra, odd.schema))
    assert by_row(quality_rules.base_statistics(df), "doc_id", *STATS) == Counter((r[0], *base(r[1])) for r in [*odd_rows, *extra])
    out = quality_rules.robust_outliers(df)
    assert out.count() == len(odd_rows) + len(extra)
    failed = {r["doc_id"]: r["base_failed"] for r in out.collect()}
    assert failed[1] and failed[202] and not failed[4]
    assert not [r for r in out.collect() if r["base_failed"] and r["kept"]]
    assert quality_rules.robust_outliers(empty).count() == 0
    assert quality_rules.robust_outliers(clashing).count() == len(odd_rows)


def test_rules_reject_outliers(spark):
    rows = [(i, prose("en", i, 150), "en", "s", 1) for i in range(400)] + [(1000 + i, prose("en", i, 150).replace(" ", "*** "), "en", "s", 1) for i in range(60)]
    got = quality_rules.robust_outliers(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    kept = {r["doc_id"]: r["kept"] for r in got.collect()}
    assert sum(kept[i] for i in range(400)) >= 395 and not any(kept[1000 + i] for i in range(60))


def test_estimate_equals_numpy(spark):
    """Least determinant of many starts with exact halves in numpy: the distributed estimate comes as low, and the distances agree."""
    rng = np.random.default_rng(4)
    mix = rng.normal(size=(5, 5)) + 2 * np.eye(5)
    clean, far = rng.normal(size=(1500, 5)) @ mix, rng.normal(size=(300, 5)) * 0.3 + 12
    x = np.concatenate([clean, far]) * 3
    rows = spark.createDataFrame([("g", i % 16, *map(float, v)) for i, v in enumerate(x)], "grp string, salt int, x0 double, x1 double, x2 double, x3 double, x4 double")
    fit = quality_rules.covariances(rows).first()
    floors, h = np.diag(np.array(quality_rules.FLOORS) ** 2 / 2), int(np.ceil(0.75 * len(x)))
    best = None
    for start in range(30):
        own = x[rng.choice(len(x), 40, replace=False)]
        for _ in range(40):
            cov = np.cov(own.T, bias=True) + floors
            d2 = np.einsum("ij,jk,ik->i", x - own.mean(0), np.linalg.inv(cov), x - own.mean(0))
            own = x[np.argsort(d2)[:h]]
        found = np.linalg.slogdet(np.cov(own.T, bias=True) + floors)[1], own
        best = found if best is None or found[0] < best[0] else best
    assert fit["logdet"] == pytest.approx(best[0], abs=0.1)
    low = np.array([[fit[f"l{i}{j}"] if j <= i else 0.0 for j in range(5)] for i in range(5)])
    want = np.cov(best[1].T, bias=True) + floors
    assert np.allclose(low @ low.T, want, atol=0.05 * np.abs(want).max()) and np.allclose([fit[f"m{i}"] for i in range(5)], best[1].mean(0), atol=0.3)
    d2 = {r["salt"]: r for r in quality_rules._distance(rows.limit(16), quality_rules.covariances(rows).drop("start", "logdet")).collect()}
    z = np.linalg.solve(low, (x[:16] - np.array([fit[f"m{i}"] for i in range(5)])).T)
    assert np.allclose([d2[i]["d2"] for i in range(16)], (z * z).sum(0))


def test_convolution_equals_a_direct_one():
    """The tabulated forward pass against windows of summed word vectors, one filter and place at a time."""
    import pyarrow as pa

    rng = random.Random(6)
    words = "stone river cloud ember frost maple thorn vile rotten cursed".split()
    texts = [" ".join(rng.choice(words[:7] if i % 3 else words) for _ in range(rng.randint(1, 40))) for i in range(60)] + ["", "one"]
    label = np.array([float(any(w in t for w in words[7:])) for t in texts])
    column = pa.array(texts, pa.large_string())
    model = toxicity.Convolution(toxicity.Vocabulary.of(column, forms=True))
    model.fit(column, label)
    rows, starts, ends = model.rows(column)
    want = []
    for s, e in zip(starts, ends, strict=True):
        x = [sum(model.emb[k] for k in rows[i]) for i in range(s, e + toxicity.PAD)]
        total, at = model.base, 0
        for w in toxicity.WIDTHS:
            for f in range(model.filters):
                best = max(sum(float(x[i + j] @ model.kernels[w][j][:, f]) for j in range(w)) + float(model.bias[w][f]) for i in range(e - s))
                total += max(best, 0.0) * float(model.out[at])
                at += 1
        want.append(total)
    assert np.allclose(model.raw(column), want, atol=1e-3)
    assert np.allclose(model.raw(column), np.concatenate([model.raw(column[i : i + 1]) for i in range(len(texts))]), atol=1e-3)


def test_languages_equal_plain_compression(spark):
    """Predictions against zstandard called for one text and one dictionary at a time."""
    import math

    import zstandard

    rows = [(i, prose(("en", "de")[i % 2], i, 20 + i), ("en", "de")[i % 2]) for i in range(60)] + [(100, "12 34", "en"), (101, None, None), (102, prose("de", 7, 3000), None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    data = langid.dictionaries(df.where(langid.training_rows(df)))
    for r in langid.predict(df).collect():
        text = dict((x[0], x[1]) for x in rows)[r["doc_id"]]
        bare = re.sub(r"[\W\d_]+", " ", text.lower()) if text else ""
        if not re.search(r"[^\W\d_]", text or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        sizes = {}
        for lang, d in data.items():
            known = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            one = lambda part: len(zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False).compress(part.encode()))  # noqa: B023, E731
            sizes[lang] = sum(one(bare[i : i + langid.PIECE]) for i in range(0, len(bare), langid.PIECE))
        best, second = sorted(sizes, key=lambda k: (sizes[k], k))
        assert abs(sizes[r["lang_pred"]] - sizes[best]) <= 2  # a prepared dictionary may find a match or two more
        assert abs(r["score"] - (1 - math.exp(-(sizes[second] - sizes[best]) / langid.SCALE))) < 0.2
    assert set(langid.dictionaries(df.where("lang is not null"), all_bytes=2_000)) == {"de", "en"}
    with pytest.raises(ValueError):
        langid.dictionaries(df.where("lang is not null"), most_languages=1)


def test_samples_are_bounded_in_bytes(spark):
    from ledgerloom.llm.common import bounded_texts

    df = spark.createDataFrame([(i, "x" * 1000) for i in range(400)], "doc_id bigint, text string")
    chosen = df.select("doc_id")
    assert bounded_texts(df, chosen).count() == 400 and 60 <= bounded_texts(df, chosen, 100_000).count() <= 140


def test_toxicity_learns_from_every_label(labelled, monkeypatch):
    docs, marks = labelled
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda rows, *a, f=toxicity.train: seen.append(rows.count()) or f(rows, *a))
    times = docs.sparkSession.range(10).select((F.col("id") * 1000).alias("more"))
    many, marked = (x.crossJoin(times).withColumn("doc_id", F.col("doc_id") + F.col("more")).drop("more") for x in (docs, marks))
    got = toxicity.predict(many, marked, shard=1500)
    assert seen == [marked.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0).count()] and seen[0] > 6500
    assert accuracy(got, marked, "toxic") > 0.97


def test_calibration_equals_numpy(spark):
    from ledgerloom.llm.hashed_text import platt

    rng = np.random.default_rng(3)
    raw = rng.normal(0, 2, 500)
    y = (rng.random(500) < 1 / (1 + np.exp(1 - 1.7 * raw))).astype(int)
    df = spark.createDataFrame([(float(r), int(v), "en") for r, v in zip(raw, y, strict=True)], "raw double, y bigint, lang string")
    assert np.allclose(toxicity._calibrated(df), platt(raw, y.astype(float)), atol=1e-6)


def test_toxicity_shards_are_whole_and_smaller_than_their_texts(labelled, monkeypatch):
    import pyarrow as pa

    docs, marks = labelled
    shards, chosen = [], F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0
    monkeypatch.setattr(toxicity, "LABELS_MOST", 200, raising=False)
    monkeypatch.setattr(toxicity, "stored", lambda df, label, f=toxicity.stored: shards.append((label, out := f(df, label))) or out)
    monkeypatch.setattr(toxicity, "discard", lambda *a: None)
    assert accuracy(toxicity.predict(docs, marks), marks, "toxic") > 0.95
    joined = [t for label, t in shards if label == "toxicity-labelled"]
    assert len(joined) > 1 and sum(t.count() for t in joined) == marks.where(chosen).count()
    (texts,) = [t for label, t in shards if label == "toxicity-texts"]
    fitted = docs.join(marks.where(chosen & (F.pmod(F.xxhash64("doc_id", F.lit("check")), F.lit(5)) != 4)), "doc_id").orderBy("doc_id").collect()
    (row,) = texts.collect()
    assert sum(len(x) if isinstance(x, (bytes, bytearray)) else sum(map(len, map(str, x))) for x in row[1:]) < sum(len(r["text"]) for r in fitted) / 2
    slots, words, counts, y = (toxicity._unpacked(x, t) for x, t in zip(row[1:], (np.int32, np.int32, np.int32, np.int8), strict=True))
    want, of = toxicity.word_forms(pa.array([r["text"] for r in fitted]))
    assert (slots.reshape(-1, 3)[words] == want).all() and (counts == np.bincount(of, minlength=len(fitted))).all()
    assert y.tolist() == [r["toxic"] for r in fitted]
