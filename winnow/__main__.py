"""Command lines: merge metric tables, select by a spec, run a funnel of tiers.

    python -m winnow merge --entries metrics/ 'more/*_x.csv' --output wide
    python -m winnow select --entries metrics/ --spec spec.json --output-prefix out/run [--fasta designs.fasta]
    python -m winnow funnel --spec funnel.json --entries pool/ --folder out/funnel

A funnel's JSON is {"tiers": [{"metrics": [entries ...], "spec": {...}}, ...]}; a tier that is written already is not made again.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from winnow.functions.values import infer_numbers
from winnow.operators import merge, select
from winnow.plans.pipeline import run_funnel
from winnow.sources import text


def merged(spark: SparkSession, entries: list[str], numbers: bool = True) -> DataFrame:
    """The tables of files, folders and globs, merged by ID in that order."""
    paths = text.resolve_paths(spark, entries)
    if not paths:
        raise ValueError(f"no tables in {entries}")
    wide = merge.first_wins([text.read_metric(spark, p) for p in paths])
    return infer_numbers(wide) if numbers else wide


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    p = argparse.ArgumentParser(prog="winnow", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = p.add_subparsers(dest="command", required=True)
    m, s, f = (commands.add_parser(x) for x in ("merge", "select", "funnel"))
    for c in (m, s, f):
        c.add_argument("--entries", nargs="+", required=True, help="CSV files, folders and globs")
    m.add_argument("--output", required=True)
    m.add_argument("--kind", choices=("csv", "parquet"), default="csv")
    s.add_argument("--spec", required=True, help="JSON file")
    s.add_argument("--output-prefix", required=True)
    s.add_argument("--fasta")
    s.add_argument("--title", default="Selection")
    s.add_argument("--target-substrate")
    f.add_argument("--spec", required=True, help="JSON file with the tiers")
    f.add_argument("--folder", required=True)
    a = p.parse_args(argv)
    spark = spark or SparkSession.builder.appName("winnow").getOrCreate()
    if a.command == "merge":
        text.write_wide(merged(spark, a.entries, numbers=False).orderBy("ID"), a.output, a.kind)
        return
    with open(a.spec) as file:
        spec = json.load(file)
    if a.command == "select":
        trace: list = []
        sequences = text.read_fasta(spark, a.fasta, token=True) if a.fasta else None
        out = select.run_selection(merged(spark, a.entries), spec, sequences, target=a.target_substrate, trace=trace)
        text.write_selection(out, a.output_prefix, select.manifest(trace, spec, a.title))
        return
    tiers = [{**t, "metrics": [lambda survivors, e=t["metrics"]: merged(spark, e, numbers=False)] if t.get("metrics") else []} for t in spec["tiers"]]
    run_funnel(spark, merged(spark, a.entries, numbers=False), tiers, a.folder)


if __name__ == "__main__":
    main()
