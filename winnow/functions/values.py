"""Missing values, numeric text and identifier columns.

Everything missing is NULL inside the engine: NaN and the missing tokens are
turned into NULL where data come in, so comparisons, aggregates and sorts follow SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What counts as missing in a text cell, and names of the key column by priority.
MISSING = ("", "nan", "NA", "NaN", "None", "null")
ID_NAMES = ("ID", "id", "Id", "fa_id", "reference_id")
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def number(c: Column, dtype: T.DataType | None = None) -> Column:
    """The value as a double; text that is no plain number, and NaN, give NULL."""
    if isinstance(dtype, T.NumericType) or isinstance(dtype, T.BooleanType):
        d = c.cast("double")
    else:
        d = F.when(c.cast("string").rlike(_NUMBER), F.trim(c.cast("string")).try_cast("double"))
    return F.when(~F.isnan(d), d)


def number_of(df: DataFrame, name: str) -> Column:
    return number(F.col(f"`{name}`"), df.schema[name].dataType)


def without_missing(df: DataFrame) -> DataFrame:
    """NaN and missing tokens become NULL in every column."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        elif isinstance(f.dataType, T.StringType):
            c = F.when(~F.trim(c).isin(*MISSING), c)
        out.append(c.alias(f.name))
    return df.select(*out)


def id_column(columns: list[str]) -> str | None:
    return next((n for n in ID_NAMES if n in columns), None)


def with_id(df: DataFrame) -> DataFrame:
    """The key column under the name ID, as text."""
    name = id_column(df.columns)
    if name is None:
        raise ValueError(f"no identifier column among {df.columns}")
    rest = [F.col(f"`{c}`") for c in df.columns if c != name and c != "ID"]
    return df.select(F.col(f"`{name}`").cast("string").alias("ID"), *rest)


def strip_names(df: DataFrame) -> DataFrame:
    """Column names without blanks around them."""
    return df.toDF(*[c.strip() for c in df.columns])


def first_token(c: Column) -> Column:
    """Text before the first blank or tab."""
    return F.regexp_extract(c, r"^([^ \t]*)", 1)


def infer_numbers(df: DataFrame, skip: tuple[str, ...] = ("ID",)) -> DataFrame:
    """Text columns in which every present value is a number become doubles (one pass over the data)."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip]
    if not text:
        return df
    stats = df.agg(*[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(text)], *[F.count(number_of(df, c)).alias(f"k{i}") for i, c in enumerate(text)]).first()
    good = {c for i, c in enumerate(text) if stats[f"n{i}"] == stats[f"k{i}"] and stats[f"n{i}"]}
    return df.select(*[number_of(df, c).alias(c) if c in good else F.col(f"`{c}`") for c in df.columns])


def all_of(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def any_of(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def greatest(parts: list[Column]) -> Column:
    """Row-wise maximum, NULL only where all are."""
    return parts[0] if len(parts) == 1 else F.greatest(*parts)
