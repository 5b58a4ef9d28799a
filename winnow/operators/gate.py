"""Gate: nested conditions over one wide table, compiled to a Catalyst predicate.

A condition is a leaf ``{"col": ..., <op>: value}``, ``{"all_of": [...]}``,
``{"any_of": [...]}`` or carries ``"when": condition``, under which alone it
applies.  A missing value fails every test but isnull; each leaf is made two-valued
before it is negated, so no NULL leaks through ``when``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnow.functions.values import all_of, any_of, number_of

_ORDER = {"lt": "<", "le": "<=", "gt": ">", "ge": ">="}
OPS = ("isnull", "notnull", "eq", "ne", "in", "not_in", "between", *_ORDER)


def _truth(c: Column) -> Column:
    return F.lower(F.trim(c.cast("string"))).isin("true", "1", "1.0")


def _same_kind(value: object, dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StringType):
        return isinstance(value, str)
    if isinstance(dtype, T.BooleanType):
        return isinstance(value, bool)
    return isinstance(value, (int, float)) and isinstance(dtype, T.NumericType)


def leaf(df: DataFrame, cond: dict) -> Column:
    name = cond["col"]
    if name not in df.columns:
        raise ValueError(f"gate: no column {name!r}")
    ops = [o for o in OPS if o in cond]
    if not ops:
        raise ValueError(f"gate: no test in {cond}")
    c, dtype, op = F.col(f"`{name}`"), df.schema[name].dataType, ops[0]
    v = cond[op]
    present = c.isNotNull() & ~F.isnan(c) if isinstance(dtype, (T.DoubleType, T.FloatType)) else c.isNotNull()
    if op == "isnull":
        return ~present if v else present
    if op == "notnull":
        return present if v else ~present
    if op in ("eq", "ne"):
        if isinstance(v, bool):
            test = _truth(c) == F.lit(v)
        else:
            test = (c == F.lit(v)) if _same_kind(v, dtype) else F.lit(False)
        test = test if op == "eq" else ~test
    elif op in ("in", "not_in"):
        usable = [x for x in v if _same_kind(x, dtype)]
        test = c.isin(*usable) if usable else F.lit(False)
        test = test if op == "in" else ~test
    elif op == "between":
        test = c.cast("double").between(float(v[0]), float(v[1]))  # text that is no number is an error
    else:
        n = number_of(df, name)
        test = {"lt": n < v, "le": n <= v, "gt": n > v, "ge": n >= v}[op]
    return F.coalesce(present & test, F.lit(False))


def compile_condition(df: DataFrame, cond: dict) -> Column:
    if "when" in cond:
        body = {k: v for k, v in cond.items() if k != "when"}
        return ~compile_condition(df, cond["when"]) | compile_condition(df, body)
    if "all_of" in cond:
        return all_of([compile_condition(df, c) for c in cond["all_of"]])
    if "any_of" in cond:
        return any_of([compile_condition(df, c) for c in cond["any_of"]])
    return leaf(df, cond)


def describe(cond: dict) -> str:
    if "when" in cond:
        return f"when ({describe(cond['when'])}): {describe({k: v for k, v in cond.items() if k != 'when'})}"
    for key, word in (("all_of", " and "), ("any_of", " or ")):
        if key in cond:
            return "(" + word.join(describe(c) for c in cond[key]) + ")"
    op = next(o for o in OPS if o in cond)
    return f"{cond['col']} {_ORDER.get(op, op)} {cond[op]}"


def apply_gate(df: DataFrame, conditions: list[dict], keep_only_passing: bool = True) -> DataFrame:
    """Rows that pass all conditions, with gate_pass; or all rows with it."""
    test = all_of([compile_condition(df, c) for c in conditions])
    return df.filter(test).withColumn("gate_pass", F.lit(True)) if keep_only_passing else df.withColumn("gate_pass", test)


def gate_counts(df: DataFrame, conditions: list[dict]) -> DataFrame:
    """condition, n_pass of each condition on its own, in one aggregate."""
    row = df.agg(*[F.count(F.when(compile_condition(df, c), 1)).alias(f"c{i}") for i, c in enumerate(conditions)])
    pairs = F.array(*[F.struct(F.lit(describe(c)).alias("condition"), F.col(f"c{i}").alias("n_pass")) for i, c in enumerate(conditions)])
    return row.select(F.inline(pairs))
