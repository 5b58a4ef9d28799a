"""Tables, shared folders and small helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Where a session on one machine has none, as in tests, one is set; on a
    cluster a local folder would be no place for it, so that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not context._jsc.sc().getCheckpointDir().isDefined():
            context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="winnow-"))
        found = context._jsc.sc().getCheckpointDir().get()
    # with its scheme, so that Spark's writers and others mean the same store
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(found)
    full = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return ("file://" + full.removeprefix("file:") if full.startswith("file:/") and not full.startswith("file://") else full).rstrip("/")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: later steps start from
    the files, so the lineage ends here and no lost executor matters."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/winnow-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table that kept() made and nobody reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: The word class of the contracts: everything but space and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(col: str = "text"):
    """Words in a text as a built-in expression; null counts as none."""
    return F.coalesce(F.regexp_count(F.col(col), F.lit(WORD)), F.lit(0)).cast("long")


def numbered(df: DataFrame, prefix: str = "c") -> DataFrame:
    """The columns named by their place, so that no name clashes with any other, in whatever case."""
    return df.toDF(*[f"{prefix}{i}" for i in range(len(df.columns))])


def place(df: DataFrame, name: str) -> int:
    """The place of the column of exactly this name, else of the first that is so in any case."""
    low = [x.lower() for x in df.columns]
    return df.columns.index(name) if name in df.columns else low.index(name.lower())


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only these columns; one of the same name in other case, or any extra one, is not read."""
    d = numbered(df)
    return d.select(*[F.col(f"c{place(df, n)}").alias(n) for n in names])
