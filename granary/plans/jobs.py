"""Whole runs: raw files to cleaned tables, cleaned tables to marts.

    spark-submit granary/plans/jobs.py silver RAW_DIR SILVER_DIR [--only NAME,...]
    spark-submit granary/plans/jobs.py gold GOLD_DIR [--province-wide NAME,...]
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Iterable, Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators.marts import validate_mart
from granary.operators.quality import (
    SCORED_CHECKS,
    Watch,
    assess,
    assess_watched,
    column_probes,
    probe_measures,
    quality_report,
)
from granary.operators.rules import require
from granary.plans import presets
from granary.sources.delimited import kind_measures, read_source, with_kinds
from granary.sources.tables import (
    load_table,
    register_table,
    remove_folder,
    stage,
    staging_folder,
    summary_of,
    write_bucketed,
    write_table,
)

logger = logging.getLogger(__name__)

# Marks raw lines of the wrong shape while they are staged.
_FLAG = "_wrong_shape"


def clean_to_table(
    spark: SparkSession,
    name: str,
    raw: DataFrame,
    path: str,
    database: str = "silver",
    aliases: presets.Aliases = None,
    assessed: bool = False,
) -> dict:
    """Clean one raw frame, check it, write it and register it; returns its summary.

    The raw file is parsed once, into staged columns: rows, lines of the wrong shape and, for an
    assessed dataset, the kinds of its columns are counted as they are written. The counts of the
    table, and the column checks of its score, are taken as it is written. Tasks that run again
    after a lost executor count once. A failed gate leaves an older table untouched.
    """
    dataset, spec = presets.DATASETS[name], presets.quality_spec(name)
    missing = dataset.missing(raw)
    if missing:
        raise ValueError(f"{name}: raw columns missing: {', '.join(missing)}")
    folder = staging_folder(spark, f"{path.rstrip('/')}_staging")
    made = []

    def staged(df: DataFrame) -> DataFrame:
        found, place = stage(df, folder)
        made.append(place)
        return found

    flagged = raw.withColumn(_FLAG, dataset.corrupt(raw))
    seen = Watch(
        {"rows_in": "count(*)", "corrupt_rows": f"count(CASE WHEN {_FLAG} THEN 1 END)"}
        | (kind_measures(raw) if assessed else {})
    )
    try:
        columnar = staged(seen.over(flagged)).drop(_FLAG)
        counted = seen.values()
        summary = {}
        if assessed:
            typed = with_kinds(columnar, counted).drop(presets.CORRUPT)
            summary["quality"] = quality_report(assess(typed, spec, checks=SCORED_CHECKS)).first().asDict()
        cleaned = staged(dataset.cleaned(columnar, aliases))
        if not require(cleaned, dataset.gate.columns, dataset.gate.min_rows):
            raise ValueError(f"{name}: fewer than {dataset.gate.min_rows} usable rows")
        probes = column_probes(cleaned, spec) if assessed else []
        predicates = dataset.gate.counts()
        watch = Watch(probe_measures(probes) | {f"gate_{at}": f"count_if(_gate_{at})" for at in range(len(predicates))})

        def watched(df: DataFrame) -> DataFrame:
            gates = {f"_gate_{at}": predicate for at, predicate in enumerate(predicates.values())}
            return watch.over(df.withColumns(gates)).drop(*gates)

        write_table(cleaned, path, presets.YEAR, watch=watched)
        values = watch.values()
        summary |= summary_of(counted["rows_in"], values["rows_"])
        summary["corrupt_rows"] = counted["corrupt_rows"]
        if assessed:
            judged = assess_watched(cleaned, spec, watch)
            summary["table_quality"] = quality_report(judged).first().asDict()
    finally:
        for place in made:
            remove_folder(spark, place)
    register_table(spark, f"{database}.{name}", cleaned.schema, path, [presets.YEAR])
    counts = {metric: values[f"gate_{at}"] for at, metric in enumerate(predicates)}
    logger.info("%s: %s %s", name, summary, counts)
    return summary | counts


def run_silver(
    spark: SparkSession,
    raw_dir: str,
    silver_dir: str,
    names: Iterable[str] = tuple(presets.DATASETS),
    database: str = "silver",
    assessed: Iterable[str] = ("produksi_pangan",),
    aliases: presets.Aliases = None,
) -> dict[str, dict]:
    """Clean the named raw files into tables; returns one summary per dataset.

    Raw files named in ``assessed`` are scored, with columns of numbers taken as numbers, and so
    are their tables (``quality`` and ``table_quality``); a low score is reported and does not
    stop the run. ``aliases`` maps cleaned region spellings to one.
    """
    assessed = set(assessed)
    results = {}
    for name in names:
        raw = read_source(spark, f"{raw_dir.rstrip('/')}/{name}.csv", presets.DATASETS[name].source)
        target = f"{silver_dir.rstrip('/')}/{name}"
        results[name] = clean_to_table(spark, name, raw, target, database, aliases, name in assessed)
        for report in ("quality", "table_quality"):
            if report in results[name]:
                level = logging.INFO if results[name][report]["overall_score"] >= 60 else logging.WARNING
                logger.log(level, "%s: %s %s", name, report, results[name][report])
    return results


def write_mart(spark: SparkSession, mart: DataFrame, path: str, table: str) -> dict:
    """Check a mart, write it and register it; an empty one leaves the older table alone."""
    built, staged = stage(mart, staging_folder(spark, f"{path.rstrip('/')}_staging"))
    try:
        checked = validate_mart(built, presets.MART_REQUIRED, presets.REGION).first()
        if not checked["valid"]:
            raise RuntimeError(f"{table} is empty")
        write_table(built, path, presets.YEAR)
    finally:
        remove_folder(spark, staged)
    register_table(spark, table, mart.schema, path, [presets.YEAR])
    return checked.asDict()


def mart_bucketed(
    production: DataFrame,
    sources: Mapping[str, DataFrame | None],
    database: str,
    folder: str,
    buckets: int,
    heaviest: float = 2.0,
) -> DataFrame:
    """The enriched mart from summaries kept in buckets of region and year, joined without a shuffle.

    Summaries have one row per key. The socio-economic rows may repeat keys: they are bucketed
    unless one key has more than ``heaviest`` times the rows of a mean bucket. Then they
    stay as they are and are joined last, with a shuffle, in which Spark may split that key.
    """
    base, parts = presets.mart_parts(production, sources)
    root = folder.rstrip("/")

    def kept(name: str, frame: DataFrame) -> DataFrame:
        return write_bucketed(frame, f"{database}.{name}", f"{root}/{name}", presets.KEYS, buckets)

    stored = []
    for part in parts:
        if not part.unique:
            per_key = part.frame.groupBy(*presets.KEYS).agg(F.count("*").alias("n"))
            most, total = per_key.agg(F.max("n"), F.sum("n")).first()
            if (most or 0) > max(heaviest * (total or 0) / buckets, 1):
                stored.append(part)
                continue
        # A left join is right for repeated keys as well; unique says that nothing needs splitting.
        stored.append(replace(part, frame=kept(part.name, part.frame), unique=True))
    return presets.finish_enriched(kept("produksi_pangan", base), stored)


def run_gold(
    spark: SparkSession,
    gold_dir: str,
    database: str = "gold",
    silver: str = "silver",
    mart_options: Mapping | None = None,
) -> dict[str, dict]:
    """Build both marts from the cleaned tables that are there."""
    production = load_table(spark, f"{silver}.produksi_pangan")
    sources = {
        name: load_table(spark, f"{silver}.{name}", required=False)
        for name in presets.SOURCE_AGGS
    }
    marts = {
        "ketahanan_pangan_kab": presets.mart_indicators(production),
        "ketahanan_pangan_enriched": presets.mart_enriched(
            production, sources, **(mart_options or {})
        ),
    }
    folder = gold_dir.rstrip("/")
    return {
        name: write_mart(spark, mart, f"{folder}/{name}", f"{database}.{name}")
        for name, mart in marts.items()
    }


def _listed(text: str) -> list[str]:
    return [name for name in text.split(",") if name]


def _alias(text: str) -> tuple[str, str]:
    spelling, _, name = text.partition("=")
    if not name:
        raise argparse.ArgumentTypeError(f"not SPELLING=NAME: {text!r}")
    return spelling, name


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    """What a run is asked to do on the command line."""
    parser = argparse.ArgumentParser(description=__doc__)
    layers = parser.add_subparsers(dest="layer", required=True)
    silver = layers.add_parser("silver", help="raw files to cleaned tables")
    silver.add_argument("raw_dir")
    silver.add_argument("silver_dir")
    silver.add_argument("--only", type=_listed, default=list(presets.DATASETS), metavar="NAME,...")
    silver.add_argument("--assess", type=_listed, default=["produksi_pangan"], metavar="NAME,...")
    silver.add_argument("--alias", type=_alias, action="append", default=[], metavar="SPELLING=NAME")
    silver.add_argument("--database", default="silver")
    gold = layers.add_parser("gold", help="cleaned tables to marts")
    gold.add_argument("gold_dir")
    gold.add_argument("--database", default="gold")
    gold.add_argument("--silver", default="silver", help="database of the cleaned tables")
    gold.add_argument("--province-wide", type=_listed, default=[], metavar="NAME,...")
    gold.add_argument("--unique-social", action="store_true")
    args = parser.parse_args(given)
    unknown = {
        name for option in ("only", "assess", "province_wide") for name in getattr(args, option, [])
    }.difference(presets.DATASETS)
    if unknown:
        parser.error(f"unknown datasets: {', '.join(sorted(unknown))}")
    return args


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, dict]:
    """Do what :func:`arguments` holds."""
    if args.layer == "silver":
        return run_silver(
            spark, args.raw_dir, args.silver_dir, args.only, args.database, args.assess, dict(args.alias)
        )
    options = {"province_wide": tuple(args.province_wide), "unique_social": args.unique_social}
    return run_gold(spark, args.gold_dir, args.database, args.silver, options)


def main() -> None:
    args = arguments()
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName(f"granary-{args.layer}").getOrCreate()
    for name, result in run(spark, args).items():
        print(name, result)


if __name__ == "__main__":
    main()
