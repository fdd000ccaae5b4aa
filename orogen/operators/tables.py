"""Filters and bulk edits of attribute tables.

A condition is {"col", "op", "values"}; a list of them means all.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orogen.functions.names import OPERATORS, aliases, kind_of

#: Fixed value: what counts as a number in a text (a literal's type suffix does not).
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number(column: Column) -> Column:
    """The value as a double, null if its text is not a number."""
    text = column.cast("string")
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def condition(df: DataFrame, cond: dict) -> Column | None:
    """A condition as a column; None if the table lacks its column. A null differs from every value."""
    name, op, values = cond["col"], cond["op"], list(cond["values"])
    if name not in df.columns:
        return None
    kind = kind_of(df.schema[name].dataType)
    if op not in OPERATORS[kind]:
        raise ValueError(f"{op} does not suit a {kind} column")
    c = F.col(name)
    typed = [F.lit(float(v)) if kind == "numeric" else F.lit(str(v)).cast(df.schema[name].dataType) for v in values]
    if op == "==":
        return F.coalesce(c == typed[0], F.lit(False))
    if op == "!=":
        return ~c.eqNullSafe(typed[0])
    if op == "between":
        return c.between(typed[0], typed[1])
    if op == "in":
        return c.isin(*typed)
    return {">": c > typed[0], ">=": c >= typed[0], "<": c < typed[0], "<=": c <= typed[0]}[op]


def filtered(df: DataFrame, conditions: Sequence[dict]) -> DataFrame:
    """Rows that meet all conditions; those on unknown columns are ignored."""
    known = [c for c in (condition(df, x) for x in conditions) if c is not None]
    return df.where(reduce(and_, known)) if known else df


def where_clause(conditions: Sequence[dict]) -> tuple[str, dict[str, object]]:
    """The same conditions as an SQL text with named parameters, for `spark.sql(..., args=)`; a null meets none."""
    texts, args = [], {}
    for n, cond in enumerate(conditions):
        names = []
        for k, value in enumerate(cond["values"]):
            args[f"p{n}_{k}"] = value
            names.append(f":p{n}_{k}")
        column = "`" + cond["col"].replace("`", "``") + "`"
        if cond["op"] == "in":
            texts.append(f"{column} IN ({', '.join(names)})")
        elif cond["op"] == "between":
            texts.append(f"{column} BETWEEN {names[0]} AND {names[1]}")
        else:
            texts.append(f"{column} {'=' if cond['op'] == '==' else cond['op']} {names[0]}")
    return " AND ".join(texts) or "TRUE", args


def one_of(column: str, values: Sequence[object], with_null: bool = False) -> Column:
    """Exact match with any of the values, as text; null too if asked for."""
    c = F.col(column)
    hit = F.coalesce(c.cast("string").isin(*[str(v) for v in values]), F.lit(False)) if values else F.lit(False)
    return hit | c.isNull() if with_null else hit


def matches(column: str, pattern: str) -> Column:
    """Whether the pattern (a Java regular expression) is found; null has no match."""
    return F.coalesce(F.col(column).cast("string").rlike(pattern), F.lit(False))


def overwrite(df: DataFrame, column: str, mask: Column, value: object) -> DataFrame:
    """The constant where the mask holds; an empty one stands for null."""
    kind = df.schema[column].dataType
    new = F.lit(None).cast(kind) if value in (None, "") else F.lit(value).try_cast(kind)
    return df.withColumn(column, F.when(mask, new).otherwise(F.col(column)))


def replace_text(df: DataFrame, column: str, mask: Column, pattern: str, by: str) -> DataFrame:
    text = F.col(column).cast("string")
    return df.withColumn(column, F.when(mask, F.regexp_replace(text, pattern, by)).otherwise(text))


def add(df: DataFrame, column: str, mask: Column, amount: float) -> DataFrame:
    """The column as numbers, plus the amount where the mask holds; what is no number becomes null."""
    x = number(F.col(column))
    return df.withColumn(column, F.when(mask, x + F.lit(float(amount))).otherwise(x))


def multiply(df: DataFrame, column: str, mask: Column, factor: float) -> DataFrame:
    x = number(F.col(column))
    return df.withColumn(column, F.when(mask, x * F.lit(float(factor))).otherwise(x))


def delete(df: DataFrame, mask: Column) -> DataFrame:
    return df.where(~F.coalesce(mask, F.lit(False)))


def parse_rates(df: DataFrame, names: Sequence[str], threshold: float = 0.95) -> DataFrame:
    """(column, rate, kind): share of all rows that parse as numbers; numeric from the threshold, string up to its complement."""
    rates = df.agg(*[F.avg(number(F.col(n)).isNotNull().cast("int")).alias(n) for n in names]).unpivot([], list(names), "column", "rate")
    kind = F.when(F.col("rate") >= threshold, "numeric").when(F.col("rate") <= round(1 - threshold, 12), "string").otherwise("mixed")
    return rates.withColumn("kind", kind)


def coerced(df: DataFrame, column: str, kind: str) -> DataFrame:
    """The column typed for writing: text, or numbers, whole ones as longs if all are whole."""
    if kind == "string":
        return df.withColumn(column, F.col(column).cast("string"))
    x = number(F.col(column))
    whole = df.agg(F.min(F.when(x.isNotNull(), (x % 1 == 0) & (F.abs(x) < 2.0**63)))).first()[0]
    return df.withColumn(column, F.bround(x).cast("long") if whole else x)


def as_numbers(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({n: number(F.col(n)) for n in names})


def is_missing(column: Column, numeric: bool) -> Column:
    return column.isNull() | F.isnan(column) if numeric else column.isNull()


def projected(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """These columns whatever their case; unknown ones are left out."""
    by_lower = {c.lower(): c for c in df.columns}
    return df.select(*[by_lower[n.lower()] for n in names if n.lower() in by_lower])


def aligned(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """`df` with all features by name: found under another spelling, else added as null."""
    lower = {c.lower(): c for c in df.columns}
    for feature in features:
        if feature not in df.columns:
            found = next((lower[a.lower()] for a in aliases(feature) if a.lower() in lower), None)
            df = df.withColumn(feature, F.col(f"`{found}`").cast("double") if found else F.lit(None).cast("double"))
    return df


def confident(df: DataFrame, predicted: str, probability: str, threshold: float) -> DataFrame:
    """is_confident, and the prediction as null where it is not; the threshold is clipped to 0 to 1."""
    sure = F.coalesce(F.col(probability) >= F.lit(min(max(threshold, 0.0), 1.0)), F.lit(False))
    return df.withColumns({"is_confident": sure, f"{predicted}_masked": F.when(sure, F.col(predicted))})


def with_correctness(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.withColumn("is_correct", F.col(truth).cast("string") == F.col(predicted).cast("string"))


def any_of(masks: Sequence[Column]) -> Column:
    return reduce(or_, masks)


def present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows without a null in these columns."""
    return df.dropna(subset=list(names))


def by_attribute_or_all(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Rows whose value is among these; if there are none, all rows."""
    hit = one_of(column, values)
    return df.where(hit) if df.where(hit).limit(1).count() else df
