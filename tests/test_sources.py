import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import tables, xml

MARC = """<collection xmlns="http://www.loc.gov/MARC21/slim">
<record><leader>00000nam a2200000</leader><controlfield tag="001">m1</controlfield><controlfield tag="008">{f1}</controlfield>
 <datafield tag="010" ind1=" " ind2=" "><subfield code="a"> 50-1 </subfield></datafield><datafield tag="010" ind1=" " ind2=" "><subfield code="a">x</subfield></datafield>
 <datafield tag="020" ind1=" " ind2=" "><subfield code="a">111</subfield></datafield><datafield tag="020" ind1=" " ind2=" "><subfield code="a">222</subfield></datafield>
 <datafield tag="035" ind1=" " ind2=" "><subfield code="a">(X)1</subfield></datafield><datafield tag="035" ind1=" " ind2=" "><subfield code="a">(OCoLC)99</subfield></datafield>
 <datafield tag="100" ind1=" " ind2=" "><subfield code="a">Lee, Ann.</subfield></datafield>
 <datafield tag="245" ind1=" " ind2=" "><subfield code="a">The sea :</subfield><subfield code="b">a story /</subfield><subfield code="c">by A. Lee.</subfield></datafield>
 <datafield tag="260" ind1=" " ind2=" "><subfield code="b">Knopf,</subfield><subfield code="c">circa 1950.</subfield></datafield><datafield tag="300" ind1=" " ind2=" "><subfield code="a">300 p. ;</subfield></datafield></record>
<record><leader>00000nam a2200000</leader><controlfield tag="001">m2</controlfield></record>
<record><leader>00000nam a2200000</leader><datafield tag="245" ind1=" " ind2=" "><subfield code="a">No id</subfield></datafield></record>
<record><leader>00000nam a2200000</leader><controlfield tag="001">m3</controlfield><controlfield tag="008">{f3}</controlfield><datafield tag="245" ind1=" " ind2=" "><subfield code="a">Year from fixed</subfield></datafield>
 <datafield tag="264" ind1=" " ind2=" "><subfield code="c">n.d.</subfield></datafield></record>
</collection>"""


def fixed(year):
    return f"000000s{year}    nyu           000 0 eng d"


REG = """<copyrightEntries>
<copyrightEntry id="u1" regnum="A1"><title>Sea</title><author claimant="yes"><authorName>Ann</authorName></author><publisher><pubName claimant="yes">Knopf</pubName><pubName>Other</pubName><pubPlace>NY</pubPlace></publisher><claimant>Bob</claimant><regDate date="1950-02-03">3Feb50</regDate></copyrightEntry>
<copyrightEntry id="u2"><title>Year only</title><regNum>B2</regNum><regDate>in 1965</regDate></copyrightEntry>
<copyrightEntry id=""><title>No id</title></copyrightEntry>
<copyrightEntry id="u3" regnum="A692774 A692775"><title>Range</title><copyDate date="1950-05-05"/></copyrightEntry>
<copyrightEntry id="u4" regnum="A9"><title>Later edition</title><prev-regNum>A1</prev-regNum><regDate date="1951-01-01"/></copyrightEntry>
<copyrightEntry id="u5" regnum="A77"><title>Parent</title><additionalEntry regnum="A78"><regDate date="1952-01-01"/></additionalEntry><additionalEntry regnum="A79"/></copyrightEntry>
</copyrightEntries>"""


@pytest.fixture
def files(tmp_path):
    (tmp_path / "marc.xml").write_text(MARC.format(f1=fixed(1949), f3=fixed(1961)), "utf-8")
    (tmp_path / "reg").mkdir()
    (tmp_path / "reg/a.xml").write_text(REG, "utf-8")
    row = lambda **k: "\t".join(str(k.get(c, "")) for c in tables.HEADER)
    rows = [row(entry_id="e1", id="R1", oreg="A-1", odat="1950-06-01"), row(entry_id="e2", id="R2", oreg="A692775", odat="1950-01-01"), row(entry_id="e3", id="R3", oreg="A78", odat="1952-03-01"),
            row(entry_id="e4", id="", oreg="A9", odat="1951-01-01"), row(entry_id="e5", id="R5", oreg="B2", odat="not-a-date"), "short\trow"]
    (tmp_path / "ren.tsv").write_text("\n".join(["\t".join(tables.HEADER), *rows]), "utf-8")
    return tmp_path


def test_marc(spark, files):
    rows, counts = xml.read_marc(spark, str(files / "marc.xml"))
    by = {r["control_id"]: r for r in rows.collect()}
    assert set(by) == {"m1", "m3"}
    m = by["m1"]
    assert (m["title"], m["title_main"], m["lccn"], m["oclc"], m["isbns"], m["main_author"]) == ("The sea a story", "The sea", "50-1", "99", ["111", "222"], "Lee, Ann")
    assert (m["publisher"], m["publication_year"], m["extent"], m["language_code"], m["statement_of_responsibility"]) == ("Knopf", 1950, "300 p", "eng", "by A. Lee")
    assert by["m3"]["publication_year"] == 1961
    assert {r["reason"]: r["n"] for r in counts.collect()} == {"kept": 2, "no_title": 1, "no_control_id": 1}


def test_eligibility(spark, files):
    got = {r["control_id"]: r["reason"] for r in xml.eligible_marc(spark, str(files / "marc.xml"), 1931).collect()}
    assert got["m1"] == "eligible" and got["m3"] == "eligible" and got["m2"] == "short_008"


def test_index(spark, files):
    registrations = xml.read_registrations(spark, str(files / "reg"))
    by = {r["uuid"]: r for r in registrations.collect()}
    assert set(by) == {"u1", "u2", "u3", "u4", "u5"}
    assert by["u1"]["claimants"] == ["Knopf", "Bob"] and by["u1"]["publisher_names"] == ["Knopf", "Other"] and by["u1"]["author_is_claimant"]
    assert (by["u2"]["regnum"], by["u2"]["reg_year"], by["u2"]["reg_date"]) == ("B2", 1965, None)
    assert [tuple(k) for k in by["u5"]["additional_keys"]] == [("A78", 1952)]
    renewals = tables.read_renewals(spark, str(files / "ren.tsv"))
    assert {r["entry_id"] for r in renewals.collect()} == {"e1", "e2", "e3", "e5"}
    index = tables.build_index(registrations, renewals)
    found = {r["uuid"]: (r["entry_id"], r["sibling_renewal"], r["is_range_registration"]) for r in index.collect()}
    assert found == {"u1": ("e1", None, False), "u2": (None, None, False), "u3": ("e2", None, True), "u4": (None, "e1", False), "u5": ("e3", None, False)}
    tables.write_index(index, str(files / "index"), "h1")
    assert tables.index_is_current(spark, str(files / "index"), "h1")
    assert not tables.index_is_current(spark, str(files / "index"), "h2")
    assert not tables.index_is_current(spark, str(files / "none"), "h1")


def test_other_header_is_an_error(spark, tmp_path):
    (tmp_path / "bad.tsv").write_text("a\tb\n1\t2\n")
    with pytest.raises(Exception, match="unknown header"):
        tables.read_renewals(spark, str(tmp_path / "bad.tsv")).collect()


def test_vault_and_linkage(spark, tmp_path):
    (tmp_path / "v.jsonl").write_text('{"schema":8,"marc_control_id":"m","nypl_uuid":"u","verdict":"match","labeled_at":"2026-01-01"}\n')
    store = tables.read_vault(spark, str(tmp_path / "v.jsonl"))
    newer = store.withColumn("verdict", F.lit("no_match")).withColumn("labeled_at", F.lit("2026-02-01"))
    assert [r["verdict"] for r in tables.upsert_vault(store, newer).collect()] == ["no_match"]
    (tmp_path / "bad.jsonl").write_text("{oops\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_vault(spark, str(tmp_path / "bad.jsonl")).collect()
    rows = spark.createDataFrame([("1", "2", None), ("3", "", "x")], "marc_control_id string, match_id string, note string")
    tables.write_linkage(rows, str(tmp_path / "out"), matches_only=True)
    assert [r.asDict() for r in spark.read.json(str(tmp_path / "out")).collect()] == [{"marc_control_id": "1", "match_id": "2", "note": ""}]


def test_commands_from_files_to_report(spark, files, capsys):
    import json

    from ledgerloom import cli

    at = lambda name: str(files / name)
    run = lambda *args: cli.main([*args], spark)
    first = run("index-build", "--registrations", at("reg"), "--renewals", at("ren.tsv"), "--index", at("index"))
    assert first["built"] and first["registrations"] == 5 and first["joined"] == 3 and first["ranges"] == 1 and first["propagated"] == 1
    assert not run("index-build", "--registrations", at("reg"), "--renewals", at("ren.tsv"), "--index", at("index"))["built"]
    assert run("index-build", "--registrations", at("reg"), "--renewals", at("ren.tsv"), "--index", at("index"), "--force")["built"]
    assert run("index-info", "--index", at("index"))["last"] == 1965
    assert run("prepare-marc", "--marc", at("marc.xml"), "--out", at("prepared"))["written"] and not run("prepare-marc", "--marc", at("marc.xml"), "--out", at("prepared"))["written"]
    run("match", "--index", at("index"), "--prepared", at("prepared"), "--out", at("linkage"), "--min-score", "5")
    rows = {r["marc_id"]: r for r in spark.read.json(at("linkage")).collect()}
    assert set(rows) == {"m1", "m3"} and rows["m1"]["match_source_id"] == "u1" and rows["m1"]["match_renewal_id"] == "R1" and rows["m3"]["match_type"] == ""
    entry = {"schema": 8, "marc_control_id": "m1", "nypl_uuid": "u1", "verdict": "match", "labeled_at": "2026-01-01", "match_source": "registration"}
    (files / "vault.jsonl").write_text("\n".join(json.dumps(e) for e in (entry, entry | {"nypl_uuid": "u4", "verdict": "unsure"}, entry | {"marc_control_id": "m3", "nypl_uuid": "u2", "verdict": "no_match"})))
    report = run("eval", "--index", at("index"), "--prepared", at("prepared"), "--vault", at("vault.jsonl"), "--min-score", "5", "--report", at("report"))
    assert report["evaluated"] == 1 and report["correct"] == 1 and report["f1"] == 1.0
    assert len(spark.read.json(at("report")).first()["sweep"]) == 21


def test_pools_and_wanted_records(spark, files):
    (files / "pool/eng").mkdir(parents=True)
    (files / "pool/eng/a.xml").write_text(MARC.format(f1=fixed(1949), f3=fixed(1961)), "utf-8")
    pool = xml.read_pool(spark, str(files / "pool"), ("eng", "fre"))
    assert {r["pool_language"]: r["count"] for r in pool.groupBy("pool_language").count().collect()} == {"eng": 4}
    assert xml.read_pool(spark, str(files / "pool"), ("xxx",)).count() == 0
    vault = spark.createDataFrame([("m3", "u1"), ("m9", "u1")], "marc_control_id string, nypl_uuid string")
    tables.vault_marcs(spark, vault, str(files / "pool/eng"), str(files / "dump"))
    assert [r["control_id"] for r in xml.read_marc(spark, f"{files}/dump/*")[0].collect()] == ["m3"]
    counts = xml.parse_counts(spark, str(files / "marc.xml")).first()
    assert (counts["emitted"], counts["no_control_id"], counts["no_title"]) == (2, 1, 1)
    assert tuple(xml.registration_counts(spark, str(files / "reg")).first()) == (5, 1, 0, 0, 0)


def test_filter_with_reasons(spark):
    rows = spark.createDataFrame([("1", "eligible", "eng"), ("2", "eligible", "fre"), ("3", "too_late", "eng")], "control_id string, reason string, language string")
    kept, counts = xml.filtered(rows, ("eng",))
    assert [r["control_id"] for r in kept.collect()] == ["1"] and {r["reason"]: r["n"] for r in counts.collect()} == {"eligible": 1, "language_not_asked": 1, "too_late": 1}
    assert spark.range(1).select(xml.moving_wall(F.lit("2026-05-01").cast("date"))).first()[0] == 1931


def test_cells_of_other_encodings(spark, tmp_path):
    row = ["x"] * len(tables.HEADER)
    good, bad = b"\t".join(c.encode() for c in row), b"\t".join([b"y"] * 5 + ["שלום".encode("cp1255")] + [b"z"] * 11)
    (tmp_path / "r.tsv").write_bytes(b"\n".join(["\t".join(tables.HEADER).encode(), good, bad]))
    got = {r["entry_id"]: r["author"] for r in tables.read_renewals(spark, str(tmp_path / "r.tsv")).collect()}
    assert got == {"x": "x", "y": "שלום"}


def test_caches_and_stores(spark, tmp_path):
    built = []
    build = lambda: built.append(1) or spark.createDataFrame([("a", 1.0)], "token string, idf double")
    for digest in ("h1", "h1", "h2"):
        assert tables.cached_frequencies(spark, str(tmp_path / "idf"), digest, "eng", build).count() == 1
    assert len(built) == 2
    pairs = spark.createDataFrame([(1, "eng", "x"), (2, "fre", "y")], "id int, language string, v string")
    tables.append_review(pairs, str(tmp_path / "review"))
    tables.append_review(pairs.union(spark.createDataFrame([(3, "eng", "z")], pairs.schema)), str(tmp_path / "review"))
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "review")).collect()) == [1, 2, 3]
    (tmp_path / "old.jsonl").write_text('{"schema": 3, "marc_control_id": "m", "nypl_uuid": "u", "verdict": "match", "category": "typo"}\n')
    row = tables.migrated_vault(spark, str(tmp_path / "old.jsonl")).first()
    assert (row["schema"], row["was_renewed"], row["match_source"]) == (8, False, "registration")
    assert tables.read_vault_lines(spark, str(tmp_path / "old.jsonl")).count() == 1
    (tmp_path / "houses.json").write_text('[{"canonical": "Knopf", "aliases": ["Alfred A. Knopf, Inc."], "imprints": ["Borzoi Books"]}]')
    from ledgerloom.functions import identifiers

    index = identifiers.alias_index(tables.read_publishers(spark, str(tmp_path / "houses.json")))
    named = spark.createDataFrame([("The Borzoi Press",), ("Alfred A. Knopf",), ("Other",)], "name string")
    assert [r["canonical"] for r in identifiers.with_house(named, "name", index).orderBy("name").collect()] == ["Knopf", None, "Knopf"]
