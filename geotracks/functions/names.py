"""Track name patterns: ``XXX-n-n-n`` is an area, ``XXX-n-n-n-n`` a plot of that area."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The name patterns. (?s) lets the prefix hold a newline, \z is the very end.
AREA_PATTERN = r"(?s)^.{3}-[0-9]+-[0-9]+-[0-9]+\z"
PLOT_PATTERN = r"(?s)^.{3}-[0-9]+-[0-9]+-[0-9]+-[0-9]+\z"
AREA_OF_PLOT_PATTERN = r"(?s)^.{3}-[0-9]+-[0-9]+-[0-9]+"


def is_area_name(name: Column) -> Column:
    return name.rlike(AREA_PATTERN)


def is_plot_name(name: Column) -> Column:
    return name.rlike(PLOT_PATTERN)


def plot_area_key(name: Column) -> Column:
    """Area id at the start of a plot name; null when the name has no such start."""
    return F.regexp_substr(name, F.lit(AREA_OF_PLOT_PATTERN))


def track_kind(name: Column) -> Column:
    """``'area'``, ``'plot'`` or null."""
    return F.when(is_area_name(name), "area").when(is_plot_name(name), "plot")
