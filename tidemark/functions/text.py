"""Expressions that clean, coerce and normalise fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructType

#: Strings that count as true.
TRUTHY = ("1", "true", "t", "T", "yes", "y", "Y", "True")
#: The short type names of a table's description.
TYPES = {"string": StringType(), "boolean": BooleanType(), "double": DoubleType(), "integer": LongType()}


def blank(x: Column) -> Column:
    """Empty but for white space of any kind."""
    return F.regexp_replace(x, r"(?U)\s", "") == ""


def blank_to_null(x: Column) -> Column:
    """x untrimmed, or null if it is blank."""
    return F.when(~blank(x), x)


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))


def cleaned(x: Column) -> Column:
    return F.trim(F.coalesce(x, F.lit("")))


def normalized_id(x: Column) -> Column:
    """The first run of digits, or the text as it is."""
    return F.coalesce(F.nullif(F.regexp_extract(x, r"(\d+)", 1), F.lit("")), x)


def host_prefix(url: Column) -> Column:
    """Scheme and host of an http(s) address, else null."""
    return F.nullif(F.regexp_extract(url, r"^(https?://[^/]+)", 1), F.lit(""))


def to_bool(x: Column) -> Column:
    """Whether x is one of TRUTHY; null is false."""
    return F.coalesce(x.cast("string").isin(*TRUTHY), F.lit(False))


def coerced(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """df with exactly the columns of schema (name to one of TYPES), in order.

    Missing columns are null, extra ones are dropped. Blank strings become null, others
    stay untrimmed; booleans are true only for TRUTHY; doubles that can't be read become
    null, and integers 0.
    """
    out = []
    for name, kind in schema.items():
        x = F.col(name) if name in df.columns else F.lit(None).cast("string")
        if kind == "string":
            x = blank_to_null(x.cast("string"))
        elif kind == "boolean":
            x = to_bool(x)
        elif kind == "double":
            x = x.cast("string").try_cast("double")
        elif kind == "integer":
            # via double, so that a text like 3.0 is a number too
            x = F.coalesce(x.cast("string").try_cast("double").try_cast("long"), F.lit(0).cast("long"))
        else:
            raise ValueError(f"{name} has the unknown type {kind}")
        out.append(x.alias(name))
    return df.select(*out)


def struct_of(schema: dict[str, str]) -> StructType:
    out = StructType()
    for name, kind in schema.items():
        out = out.add(name, TYPES[kind])
    return out


def require(df: DataFrame, *columns: str) -> DataFrame:
    """df, if it has all columns; else an error that names the missing ones."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
