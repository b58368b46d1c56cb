"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from anchorframe.core import DAY, HOUR, micros


def label_key(label: Column | str) -> Column:
    """Case- and space-insensitive form of a label."""
    c = F.col(label) if isinstance(label, str) else label
    return F.lower(F.trim(F.coalesce(c, F.lit(""))))


def title_case(label: Column | str) -> Column:
    c = F.col(label) if isinstance(label, str) else label
    return F.initcap(F.trim(c))


def blank_to_null(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.trim(c) == "", None).otherwise(c)


def to_double(c: Column | str) -> Column:
    """Number or NULL: text that is not a number, and NaN, become NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))


def to_id(c: Column | str) -> Column:
    """Whole number or NULL; ids written as '12.0' count as 12."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.trim(c.cast("string")), r"\.0+$", "").try_cast("long")


def lookup(key: Column, table: Mapping, default: Column | None = None) -> Column:
    """Value of ``key`` in a small literal table, else ``default`` (NULL when none is given)."""
    if not table:
        return default if default is not None else F.lit(None)
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), key)
    return F.coalesce(found, default) if default is not None else found


def classify(name: Column, classes: Mapping[str, Sequence[str]], other: str = "Other") -> Column:
    """Name of the first class whose member list holds ``name``."""
    expr = None
    for cls, members in classes.items():
        cond = name.isin(list(members))
        expr = F.when(cond, cls) if expr is None else expr.when(cond, cls)
    return expr.otherwise(other) if expr is not None else F.lit(other)


def within_limits(label: Column, value: Column, limits: Mapping[str, tuple[float, float]]) -> Column:
    """Label is listed and the value lies in its inclusive bounds."""
    cond = F.lit(False)
    for name, (lo, hi) in limits.items():
        cond = cond | ((label == name) & value.between(lo, hi))
    return cond


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(float(HOUR))


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(float(DAY))


def floored_days(later: Column | str, earlier: Column | str) -> Column:
    """Whole days rounded towards minus infinity: one hour before counts as day -1."""
    return F.floor((micros(later) - micros(earlier)) / F.lit(float(DAY))).cast("long")


def half_even(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.bround(c, digits)


def decimal_comma(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c.cast("string"), r"\.", ",")


def gender_code(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == "M", 0).when(c == "F", 1).cast("byte")
