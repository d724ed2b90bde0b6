"""Expressions over columns; all run in the JVM."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    """What follows the last slash of a path."""
    return F.element_at(F.split(path, "/"), -1)


def path_stem(path: Column) -> Column:
    """File name without ``.geo.json`` (any case), else without its last suffix; a lone leading dot stays."""
    name = file_name(path)
    return F.when(F.lower(name).endswith(".geo.json"), F.regexp_replace(name, r"(?i)\.geo\.json$", "")).otherwise(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""))


def group_id() -> Column:
    """TCGA slides of one patient share 12 characters; any other slide is its own group."""
    return F.when(F.upper("source") == "TCGA", F.substring("id_stem", 1, 12)).otherwise(F.col("id_stem"))


def safe_name(name: Column) -> Column:
    """The text with characters that file names cannot hold replaced."""
    return F.regexp_replace(name, r"[^A-Za-z0-9 _.-]+", "_")


def fill_template(template: Column, **values: Column) -> Column:
    """The template with each ``{name}`` replaced by its column; null where one of these is null."""
    for key, value in values.items():
        template = F.replace(template, F.lit("{" + key + "}"), value)
    return template


def number(column: str) -> Column:
    """The column with null and NaN as 0."""
    return F.coalesce(F.nanvl(F.col(column), F.lit(0.0)), F.lit(0.0))


def coverage_family(df: DataFrame, prefix: str) -> list[str]:
    """Columns of a family in schema order; an empty family is an error."""
    names = [c for c in df.columns if c.startswith(prefix)]
    if not names:
        raise ValueError(f"no column starts with {prefix}")
    return names


def any_above(columns: list[str], floor: float = 0.0) -> Column:
    """Whether one of the columns is above 0; null and NaN are not."""
    return reduce(or_, [(F.col(c) > floor) & ~F.isnan(c) for c in columns])


def total(columns: list[str]) -> Column:
    """Sum of the columns, null and NaN as 0."""
    return reduce(add, [number(c) for c in columns])


def first_max(columns: list[str], names: list[str]) -> Column:
    """Name of the largest column, the first of equals."""
    values = F.array(*[number(c) for c in columns])
    return F.element_at(F.array(*map(F.lit, names)), F.array_position(values, F.array_max(values)).cast("int"))


def half_even(x: Column) -> Column:
    """Rounded to a whole number, halves to the even one."""
    return F.rint(x)
