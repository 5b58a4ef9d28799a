"""A dependency graph of lazily built tables, and the funnel of selection tiers."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from winnow.operators.merge import first_wins
from winnow.operators.select import run_selection


@dataclass
class Step:
    """build(inputs) makes the step's table from those of deps and, if they are there, soft_deps."""

    name: str
    build: Callable[[dict[str, DataFrame]], DataFrame]
    deps: list[str] = field(default_factory=list)
    soft_deps: list[str] = field(default_factory=list)
    needs: list[str] = field(default_factory=list)


def enabled(catalog: dict[str, bool], only: list[str] | None = None, include: list[str] = (), exclude: list[str] = ()) -> set[str]:
    """Defaults, or those named in only; then those included, without those excluded."""
    unknown = {*(only or ()), *include, *exclude} - set(catalog)
    if unknown:
        raise ValueError(f"unknown tools: {sorted(unknown)}")
    chosen = set(only) if only else {k for k, on in catalog.items() if on}
    return (chosen | set(include)) - set(exclude)


def load_catalog(path: str | None, defaults: dict[str, bool]) -> dict[str, bool]:
    """A JSON catalog over the defaults; keys it lacks are filled."""
    return defaults | (json.load(open(path)) if path else {})


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


class Engine:
    """Runs steps in order: a step without what it needs or depends on is skipped with the
    reason; one whose output exists is read, not made again; the rest are written."""

    def __init__(self, spark: SparkSession, folder: str, capabilities: set[str] = frozenset()) -> None:
        self.spark, self.folder, self.capabilities = spark, folder, capabilities
        self.log: list[tuple[str, str]] = []

    def run(self, steps: list[Step], chosen: set[str] | None = None) -> dict[str, DataFrame]:
        done: dict[str, DataFrame] = {}
        for s in steps:
            path = f"{self.folder}/{s.name}"
            if chosen is not None and s.name not in chosen:
                self.log.append((s.name, "disabled"))
            elif missing := [n for n in s.needs if n not in self.capabilities]:
                self.log.append((s.name, f"no {missing[0]}"))
            elif unmet := [d for d in s.deps if d not in done]:
                self.log.append((s.name, f"waits for {unmet[0]}"))
            else:
                if _exists(self.spark, path):
                    self.log.append((s.name, "exists"))
                else:
                    s.build({k: done[k] for k in [*s.deps, *s.soft_deps] if k in done}).write.mode("overwrite").parquet(path)
                    self.log.append((s.name, "made"))
                done[s.name] = self.spark.read.parquet(path)
        return done


def run_funnel(spark: SparkSession, pool: DataFrame, tiers: list[dict], folder: str) -> DataFrame:
    """Each tier merges its metrics (callables of the survivors) over what is carried
    forward, selects by its spec and writes the survivors, from which the next starts.

    A tier that is written already is read again, so a run that stopped goes on.
    """
    survivors = pool
    for k, tier in enumerate(tiers):
        path = f"{folder}/tier_{k}"
        if not _exists(spark, path):
            wide = first_wins([survivors, *[m(survivors) for m in tier.get("metrics", [])]])
            wide = wide.join(survivors.select("ID"), "ID", "left_semi")
            run_selection(wide, tier["spec"], clusters=tier.get("clusters"), target=tier.get("target")).write.mode("overwrite").parquet(path)
        survivors = spark.read.parquet(path)
    return survivors
