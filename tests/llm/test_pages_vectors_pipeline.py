import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import html_extract, nn_descent


def text(html):
    return html_extract.main_text([(n[0], 0, n[3], n[4], n[5]) for n in html_extract.Page(html).nodes])


def test_main_text():
    page = """<html><head><title>T</title><script>var a = "</p>";</script></head><body><div class="top-menu"><p>menu</p></div><header><h1>Site</h1></header>
    <article><h1>Head &amp;\n line</h1><p>One&nbsp;two <b>three</b><br>four<p>five &lt;six&gt;<aside>side</aside><section id="comments"><p>reader</p></section><form><p>form</p></form></article>
    <div class="cookie-notice">cookies</div><footer>foot</footer></body></html>"""
    assert text(page) == "Head & line\n\nOne two three four\n\nfive <six>"
    assert text("") == "" and text("<p>") == "" and text("plain & simple") == "plain & simple"
    assert text("<main><header><h1>T</h1></header><p>x</main><p>out") == "T\n\nx"
    assert text("<div><p>a</p>b<p>c</div>") == "a\n\nb\n\nc"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_template_text_is_dropped(spark):
    page = lambda i: f"<body><div><p>Read more on our site</p><p>story {i} {'w' * i}</p><p>All the best</p></div></body>"
    rows = [(i, f"https://h.example/{i}", page(i)) for i in range(8)]
    copies = [(100 + i, f"https://copy.example/{i}", page(3)) for i in range(8)]
    odd = [(50, None, None), (51, "nonsense", page(1)), (None, "https://h.example/x", page(9)), (52, "https://h.example/0", page(0)), (52, "https://h.example/0", page(0)), (53, "http://x/", "<p>" + "y " * 50_000)]
    got = html_extract.extract(pages(spark, rows + copies + odd).withColumn("template", F.lit(1)).withColumn("host", F.lit(1)))
    by = {r["page_id"]: r for r in got.collect()}
    assert by[2]["text"] == "story 2 ww" and by[2]["n_chars"] == 10
    assert by[103]["text"] == "Read more on our site\n\nstory 3 www\n\nAll the best"
    assert by[50]["text"] == "" and by[51]["text"].startswith("Read more") and by[53]["n_chars"] == 99_999
    assert got.count() == len(rows + copies + odd)
    assert html_extract.extract(pages(spark, [])).count() == 0


WORDS = "amber basil cedar dahlia elder fennel ginger hazel iris juniper".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.integers(1000)) for _ in range(n))


def unmarked(rng, host, i):
    """A page whose names and elements tell nothing: only what the host's pages share shows the article. Returns html and the article."""
    menu = "".join(f"<div><a href='/{i}/{k}'>{prose(rng, 2)}</a></div>" for k in range(rng.integers(3, 8)))
    body = [prose(rng, int(rng.integers(20, 80))) for _ in range(rng.integers(2, 5))]
    article = "".join(f"<div>{t}</div>" for t in body)
    frame = {
        0: f"<body><div class='qa'>{menu}</div><div class='qb'>{prose(rng, 9)}</div><div class='qc'>{article}</div><div class='qd'><b>Owned by {host}</b> {prose(rng, 5)}</div></body>",
        1: f"<body><table><tr><td class='za'>{menu}</td><td class='zb'>{article}</td><td class='zc'>{prose(rng, 6)}<i>All rights kept</i></td></tr></table></body>",
    }[len(host) % 2]
    return frame, "\n\n".join(body)


def test_classes_decide_where_no_mark_does(spark):
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for h, host in enumerate(["a.example", "bb.example", "ccc.example", "dddd.example"]):
        for i in range(12):
            html, article = unmarked(rng, host, i)
            rows.append((100 * h + i, f"https://{host}/{i}", html))
            want[100 * h + i] = article
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages(spark, rows)).collect()}
    assert got == want
    alone = {r[0]: text(r[2]) for r in rows}
    assert all(alone[i] != want[i] for i in want)  # without its host's template every page's text is another one


def test_classes_equal_brute_force(spark):
    """Tokens share a class exactly if their vectors of counts over the rows of a host are equal, also where rows are repeated."""
    rng = np.random.default_rng(8)
    rows = [(i % 5, f"https://{'ab'[i % 2]}.example/{i}", f"<body><div><p>same</p>{'<p>x</p>' * int(rng.integers(1, 3))}<b>{i % 3}</b></div></body>") for i in range(16)]
    rows += rows[:4]
    read = html_extract.stored(html_extract.parsed(pages(spark, rows).select("page_id", "url", "html", html_extract._host().alias("host"), F.monotonically_increasing_id().alias("row"))), "pages")
    vectors = {}
    for r in read.collect():
        counts = dict(zip(r["e_token"], r["e_n"], strict=True))
        for t in r["n_token"]:
            counts[t] = counts.get(t, 0) + 1
        for t, n in counts.items():
            vectors.setdefault((r["host"], t), []).append((r["row"], n))
    want = {}
    for (host, t), v in vectors.items():
        want.setdefault((host, tuple(sorted(v))), set()).add(t)
    got = {}
    for r in html_extract.occurrences(read).collect():
        assert r["n"] == len(vectors[r["host"], r["token"]])
        got.setdefault((r["host"], r["n"], r["v1"], r["v2"]), set()).add(r["token"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_main_slot():
    slot = lambda around, fresh, single=True, rank=0: {"around": around, "single": single, "fresh": fresh, "rank": rank}
    body = {1: slot(0, 100), 2: slot(1, 90), 3: slot(1, 10), 4: slot(2, 85), 5: slot(4, 80, single=False)}
    assert html_extract.main_slot(body) == 4
    assert html_extract.main_slot(body | {2: slot(1, 90, rank=3)}) == 2  # nested slots of nearly the same text: the marked one
    assert html_extract.main_slot({1: slot(0, 100), 2: slot(1, 40), 3: slot(1, 45)}) == 1 and html_extract.main_slot({}) is None


def test_deep_and_long_pages(spark):
    deep = "<div>" * 20_000 + "<p>deep</p>"
    rows = [(i, f"https://h.example/{i}", f"<body><div class='m'><a href='x'>{i}</a></div><div class='t'>{'word%d ' % i * 30_000}</div></body>") for i in range(5)]
    got = {r["page_id"]: r["n_chars"] for r in html_extract.extract(pages(spark, [*rows, (9, "https://d.example/", deep)])).collect()}
    assert got[9] == 4 and all(got[i] == 6 * 30_000 - 1 for i in range(5))


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(400, 64))
    near = base[:60] + 0.15 * rng.normal(size=(60, 64))
    clump = base[100] + 0.1 * rng.normal(size=(300, 64))
    x = np.concatenate([base, near, clump, base[:5], base[5:8] * 2]).astype(np.float32).astype(float)
    rows = [(i + 7, v.tolist()) for i, v in enumerate(x)]
    odd = [(5000, None), (5001, [0.0] * 64), (5002, [float("nan")] + [1.0] * 63), (5003, [None] + [1.0] * 63), (5004, [1.0]), (5005, [])]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>")
    got = {r["vec_id"]: r for r in nn_descent.near_duplicates(df.withColumn("key", F.lit(1)).withColumn("n", F.lit(2)).withColumn("rep", F.lit(3))).collect()}
    twice = nn_descent.near_duplicates(df.where("vec_id < 100").union(df.where("vec_id = 7")), most_k=10)
    assert twice.where("vec_id = 7").distinct().count() == 1 and twice.where("vec_id = 7").count() == 2
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    least = np.arange(len(x))
    while (low := np.minimum(least, np.where(link, least[None, :], len(x)).min(1)).tolist()) != least.tolist():
        least = np.array(low)
    for i in range(len(x)):
        r = got[i + 7]
        assert (r["n_links"], r["component_id"], r["kept"]) == (link[i].sum(), least[i] + 7, least[i] == i)
    for i, _ in odd:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert nn_descent.near_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<double>")).count() == 0


def test_lists_are_enlarged_and_counted(spark):
    """A group of few links per member is counted from its lists; a list that is full of links grows until it is not."""
    rng = np.random.default_rng(2)
    clump = rng.normal(size=64) + 0.12 * rng.normal(size=(90, 64))
    turn = np.linspace(0, 12, 120)  # a chain: each vector links with its neighbours
    chain = np.zeros((120, 64))
    chain[np.arange(120), (turn // 1.5).astype(int)] = np.cos(turn % 1.5)
    chain[np.arange(120), (turn // 1.5).astype(int) + 1] = np.sin(turn % 1.5)
    x = np.concatenate([clump, chain, rng.normal(size=(150, 64))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    for options in ({}, {"tile": 1}, {"tile": 1, "most_k": 20}):
        got = {r["vec_id"]: r["n_links"] for r in nn_descent.near_duplicates(df, **options).collect()}
        assert [got[i] for i in range(len(x))] == link.sum(1).tolist(), options


def test_recall_below_goal_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "_audited", lambda *a: 0.5)
    with pytest.raises(ArithmeticError):
        nn_descent.near_duplicates(spark.createDataFrame([(1, [1.0] * 64), (2, [1.0] * 64)], "vec_id bigint, embedding array<double>"), most_rounds=1)


def test_pipeline_stages(spark, clashing, empty):
    import corpus_pipeline

    docs = clashing
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        if name != "sentencepiece":
            assert out.columns == docs.columns, name
            docs = corpus_pipeline.stored(out, name)
            if name == "simhash_near_dedup":
                ids = [r["doc_id"] for r in docs.collect()]
                assert ids.count(4) == 1 and 5 not in ids and ids.count(8) == 1
    assert {"doc_id", "n_tokens", "ids"} <= set(out.columns) and out.count() == docs.count()
    docs = empty
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, ""), name)
    assert docs.count() == 0
