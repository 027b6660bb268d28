"""Commands: build and describe an index, prepare catalogue records, match, evaluate, and train a scorer."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config
from .operators import learned, matching, metrics, retrieval
from .session import session
from .sources import tables, xml


def _settings(args: argparse.Namespace) -> config.MatchingConfig:
    base = config.matching_config(open(args.config).read()) if args.config else config.MatchingConfig()
    given = {"year_window": args.year_window, "min_combined_score": args.min_score, "scorer": args.scorer}
    return base.with_changes(**{k: v for k, v in given.items() if v is not None})


def _marc(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return tables.read_prepared(spark, args.prepared) if args.prepared else xml.read_marc(spark, args.marc)[0]


def candidate_pairs(marc: DataFrame, cce: DataFrame, window: int) -> DataFrame:
    """(control_id, uuid) of records that share a word of title, author or publisher within the window of years."""
    from .functions import text

    names = lambda *columns: F.array_distinct(F.flatten(F.array(*(text.token_keys(c, f) for f, c in columns))))
    a = {"title": text.token_keys(F.col("title")), "author": names(("author", F.col("main_author")), ("author", F.col("statement_of_responsibility"))), "publisher": text.token_keys(F.col("publisher"), "publisher")}
    both = F.concat_ws(" ", F.array_join("publisher_names", " "), F.array_join("claimants", " "))
    b = {"title": text.token_keys(F.col("title")), "author": text.token_keys(F.col("author_name"), "author"), "publisher": text.token_keys(both, "publisher")}
    queries = retrieval.postings(marc, a, "control_id", F.col("publication_year")).withColumnRenamed("control_id", "query").where("year is not null")
    found = retrieval.candidates(queries, retrieval.postings(cce, b, "uuid", F.col("reg_year")), window)
    return found.select(F.col("query").alias("control_id"), "uuid")


def index_build(spark: SparkSession, args: argparse.Namespace) -> dict:
    digest = tables.source_hash(spark, args.registrations, args.renewals)
    if tables.index_is_current(spark, args.index, digest, args.force):
        return {"built": False}
    renewals = tables.read_renewals(spark, args.renewals)
    index = tables.build_index(xml.read_registrations(spark, args.registrations), renewals)
    tables.write_index(index, args.index, digest)
    counts = tables.index_counts(tables.read_index(spark, args.index), renewals).first().asDict()
    return {"built": True} | counts


def index_info(spark: SparkSession, args: argparse.Namespace) -> dict:
    index = tables.read_index(spark, args.index)
    return index.agg(F.count(F.lit(1)).alias("registrations"), F.count(F.when(F.col("was_renewed"), 1)).alias("joined"), F.countDistinct("reg_year").alias("years"), F.min("reg_year").alias("first"), F.max("reg_year").alias("last")).first().asDict()


def prepare(spark: SparkSession, args: argparse.Namespace) -> dict:
    return {"written": tables.prepare_marc(spark, args.marc, args.out)}


def _matched(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, DataFrame, DataFrame, config.MatchingConfig]:
    settings = _settings(args)
    marc, cce = _marc(spark, args), tables.read_index(spark, args.index)
    pairing = config.pairing_config(open(args.pairings).read()) if args.pairings else config.default_pairings()
    model = learned.load(spark, args.model, [n if n not in matching.EVIDENCE else f"s_{n}" for n in (k.replace(".", "__") for k in matching.feature_columns())]) if args.model else None
    houses = F.broadcast(matching.identifiers.alias_index(tables.read_publishers(spark, args.publishers))) if args.publishers else None
    return marc, cce, matching.match(marc, cce, candidate_pairs(marc, cce, settings.year_window), settings, pairing, matching.combiner(settings, model=model), houses), settings


def match(spark: SparkSession, args: argparse.Namespace) -> dict:
    marc, cce, matched, settings = _matched(spark, args)
    tables.write_linkage(matching.linkage(marc, cce, matching.ranked(matched, settings)), args.out, args.matches_only)
    return {"written": args.out}


def evaluate(spark: SparkSession, args: argparse.Namespace) -> dict:
    from .operators import labels

    _, _, matched, settings = _matched(spark, args)
    gold = labels.gold_labels(tables.read_vault(spark, args.vault))
    truth = labels.truth_of(gold, "labeled_at").select(F.col("marc_control_id").alias("control_id"), F.col("nypl_uuid").alias("uuid"))
    judged = gold.select(F.col("marc_control_id").alias("control_id"), F.col("nypl_uuid").alias("uuid"), (F.col("verdict") == "match").cast("int").alias("label"))
    scored = matched.join(judged, ["control_id", "uuid"]).select(F.col("calibrated").alias("score"), "label")
    report = metrics.evaluation(matching.ranked(matched, settings).where("rank = 1"), truth, metrics.check_labels(scored), "control_id", "uuid")
    if args.report:
        metrics.write_report(report, args.report)
    return json.loads(report.drop("sweep").toJSON().first())


def train_scorer(spark: SparkSession, args: argparse.Namespace) -> dict:
    _, _, matched, _ = _matched(spark, args)
    gold = tables.read_vault(spark, args.vault).where("verdict <> 'unsure'")
    judged = gold.select(F.col("marc_control_id").alias("control_id"), F.col("nypl_uuid").alias("uuid"), (F.col("verdict") == "match").cast("int").alias("label"))
    columns = {n.replace(".", "__") if n not in matching.EVIDENCE else f"s_{n}": c for n, c in matching.feature_columns().items()}
    rows = matched.join(judged, ["control_id", "uuid"]).select("control_id", "label", *(c.alias(n) for n, c in columns.items()))
    learned.save(learned.train(rows, list(columns), trees=args.trees), args.out)
    return learned.cross_validated(rows, list(columns), "control_id", trees=args.trees).first().asDict()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ledgerloom", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, run, *needed: str, matching_: bool = False) -> argparse.ArgumentParser:
        one = commands.add_parser(name)
        one.set_defaults(run=run)
        for option in needed:
            one.add_argument(f"--{option}", required=True)
        if matching_:
            one.add_argument("--marc")
            one.add_argument("--prepared")
            one.add_argument("--year-window", type=int)
            one.add_argument("--min-score", type=float)
            one.add_argument("--scorer", choices=("weighted_mean", "learned"))
            for option in ("config", "pairings", "model", "publishers"):
                one.add_argument(f"--{option}")
        return one

    command("index-build", index_build, "registrations", "renewals", "index").add_argument("--force", action="store_true")
    command("index-info", index_info, "index")
    command("prepare-marc", prepare, "marc", "out")
    command("match", match, "index", "out", matching_=True).add_argument("--matches-only", action="store_true")
    command("eval", evaluate, "index", "vault", matching_=True).add_argument("--report")
    command("train-scorer", train_scorer, "index", "vault", "out", matching_=True).add_argument("--trees", type=int, default=200)
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parser().parse_args(arguments)
    if hasattr(args, "prepared") and not (args.marc or args.prepared):
        parser().error("--marc or --prepared is needed")
    result = args.run(spark or session(), args)
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
