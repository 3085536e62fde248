"""Row filters that compare text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_text

# Operator names.
OPERATORS = {
    "equals": "equals", "eq": "equals", "=": "equals",
    "contains": "contains", "like": "contains",
    "not_equals": "not_equals", "neq": "not_equals", "!=": "not_equals",
}


def condition(df: DataFrame, field: str, operator: str = "equals", value: object = "") -> Column:
    """Condition on the text of a column.

    ``contains`` is a case-insensitive regular expression (Java dialect).  A null equals and
    contains nothing, and differs from everything.
    """
    kind = OPERATORS.get((operator or "equals").lower())
    if kind is None:
        raise ValueError(f"unknown operator {operator!r}; known: {sorted(OPERATORS)}")
    if field not in df.columns:
        raise ValueError(f"column {field!r} not found")
    text, wanted = as_text(df, field), F.lit(str(value))
    if kind == "equals":
        return text == wanted
    if kind == "contains":
        return text.rlike(f"(?i){value}")
    return ~text.eqNullSafe(wanted)


def filter_rows(df: DataFrame, field: str, operator: str = "equals", value: object = "") -> DataFrame:
    return df.where(condition(df, field, operator, value))


def search_any(df: DataFrame, query: str, columns: list[str] | None = None) -> DataFrame:
    """Rows where the text of any column contains the query, whatever the case."""
    names = columns or [f.name for f in df.schema.fields if f.dataType.typeName() not in ("struct", "array", "map")]
    needle = query.strip().lower()
    if not needle:
        return df
    hit = F.lit(False)
    for name in names:
        hit = hit | F.coalesce(F.lower(F.col(name).cast("string")).contains(needle), F.lit(False))
    return df.where(hit)
