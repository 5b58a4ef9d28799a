"""Mixing sources to target weights by systematic sampling.

Every source has a target, its share of all words by weight, stopped at
MAX_COPIES times what it has.  A document's expected copies are target over
source size.  Prefix sums of these run through each source in a fixed order,
one random offset is added, and a document is emitted once for each integer
that its interval crosses: every document gets the floor or the ceiling of its
expectation, and a source its sum to within one.

The order goes by size first (bins of a ninth), so that large and small
documents are drawn evenly, then by a slot of the id.  Source, bin and slot
make short strata: one grouped count gives the base of each, and only the rows
of a stratum are ordered together, so a source with a third of all rows is
spread over thousands of groups.  Words are counted once and stored; all else
reads the counts.

Built-in expressions only.  Defined results: a null text has size 0 and may
be drawn like any other; a null source is one of its own, after the others; a
null doc_id takes its slot from the text, one that is no whole number from a hash of it.  Rows are drawn one by one, whether or
not they repeat: three rows of one doc_id are three documents, of which equal
ones are alike to the draw.  A very long text is one row like any other; a
table without words takes nothing, an empty one gives no rows.  Only doc_id,
text and source decide; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnow.llm import common

WEIGHTS = (5.0, 2.0, 1.0)
MAX_COPIES = 3.0
#: The one random offset, drawn once for the seed 42.
OFFSET = 0.6394267984578837
#: A prime, so that ids in steps of any other number spread over all slots.
SLOTS = 1021


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, target from (source, source_size), one row per source.

    A level t fills every source to min(MAX_COPIES * size, weight * t), all of
    it together to the sum of sizes: sorted by MAX_COPIES * size / weight, the
    first few are full and the rest share what is left by weight.
    """
    s = sizes.select("source", F.col("source_size").cast("double").alias("size"))
    by_code = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    rank = F.row_number().over(by_code)
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((rank - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("full", F.col("size") * MAX_COPIES)
    up = Window.orderBy((F.col("full") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    after = up.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("size").over(up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    s = s.withColumn("level", (total - F.coalesce(F.sum("full").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    s = s.withColumn("is_full", F.col("level") * F.col("weight") >= F.col("full"))
    # the level of the first that isn't full holds for it and all after it
    first = F.min(F.when(~F.col("is_full"), F.struct((F.col("full") / F.col("weight")).alias("k"), "level"))).over(Window.partitionBy(F.lit(1)))
    s = s.withColumn("level", first["level"])
    return s.select("source", F.col("size").cast("long").alias("source_size"), F.when(F.col("is_full") | F.col("level").isNull(), F.col("full")).otherwise(F.col("level") * F.col("weight")).alias("target"))


def sized(docs: DataFrame) -> DataFrame:
    """id, source, size, tie of each row, from doc_id, source and text, and the row itself as numbered()."""
    d = common.numbered(docs)
    doc_id, source, text = (F.col(f"c{common.place(docs, x)}") for x in ("doc_id", "source", "text"))
    return d.select("*", doc_id.alias("id"), source.cast("string").alias("source"), text.cast("string").alias("text")).withColumn("size", common.n_words("text")).withColumn("tie", F.xxhash64("text")).drop("text")


def _number(rows: DataFrame) -> Column:
    """The id as a number: itself, or a hash where it is of another type."""
    return F.col("id") if isinstance(rows.schema["id"].dataType, T.IntegralType) else F.when(F.col("id").isNotNull(), F.xxhash64("id"))


def copies(stored: DataFrame, weights: tuple[float, ...] = WEIGHTS, offset: float = OFFSET) -> DataFrame:
    """Of rows with id, source, size and tie, which should be read from files: all their columns, source_size, target and copies."""
    d = stored.withColumn("bin", F.floor(F.log2(F.col("size") + 1.0) * 8).cast("int")).withColumn("slot", F.pmod(F.coalesce(_number(stored), F.col("tie")), F.lit(SLOTS)))
    strata = common.kept(d.groupBy("source", "bin", "slot").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")), "strata")
    t = targets(strata.groupBy("source").agg(F.sum("words").alias("source_size")), weights)
    earlier = Window.partitionBy("source").orderBy("bin", "slot").rowsBetween(Window.unboundedPreceding, -1)
    base = strata.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n", "words")
    plan = base.join(t.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    plan = plan.select(F.col("source").alias("_source"), F.col("bin").alias("_bin"), F.col("slot").alias("_slot"), "base", "source_size", "target")
    within = Window.partitionBy("source", "bin", "slot").orderBy("id", "size", "tie")
    k = F.col("base") + F.col("k")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    d = d.withColumn("k", F.row_number().over(within))
    on = F.col("source").eqNullSafe(F.col("_source")) & (F.col("bin") == F.col("_bin")) & (F.col("slot") == F.col("_slot"))
    d = d.join(plan, on).withColumn("rate", rate)
    crossed = F.floor(F.col("rate") * k + offset) - F.floor(F.col("rate") * (k - 1) + offset)
    return d.withColumn("copies", F.least(crossed, F.lit(int(MAX_COPIES)))).drop("_source", "_bin", "_slot", "bin", "slot", "k", "base", "rate")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, offset: float = OFFSET) -> DataFrame:
    """doc_id, size, source_size, target and taken: the words that the mix takes of each document."""
    stored = common.kept(sized(docs).select("id", "source", "size", "tie"), "sizes")
    c = copies(stored, weights, offset)
    return c.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, offset: float = OFFSET) -> DataFrame:
    """The documents themselves, with all their columns, each as many times as it is taken."""
    c = copies(common.kept(sized(docs), "sizes"), weights, offset).where("copies > 0")
    out = c.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), src AS (
  SELECT source, sum(size)::DOUBLE AS size FROM d GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, size * 3.0::DOUBLE AS cap FROM src
), lv AS (
  SELECT *, (sum(size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w
), fl AS (
  SELECT *, level * weight >= cap AS is_full FROM lv
), t AS (
  SELECT source, size::BIGINT AS source_size,
    CASE WHEN is_full THEN cap ELSE weight * (SELECT level FROM fl WHERE NOT is_full ORDER BY cap / weight, source NULLS LAST LIMIT 1) END AS target FROM fl
), o AS (
  SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY floor(log2(size + 1.0::DOUBLE) * 8), ((doc_id % {SLOTS}) + {SLOTS}) % {SLOTS}, doc_id, size) AS k FROM d
), r AS (
  SELECT o.doc_id, o.size, t.source_size, t.target, k, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate
  FROM o JOIN t ON o.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (least(floor(rate * k + {OFFSET}) - floor(rate * (k - 1) + {OFFSET}), 3) * size)::BIGINT AS taken FROM r
"""
