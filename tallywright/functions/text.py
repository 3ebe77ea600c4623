"""Text clean-up with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywright.functions.fixed_values import NAME_DELIMITERS, WHITESPACE


def strip(c: Column) -> Column:
    """Trim every kind of white space; Spark's plain trim only knows spaces."""
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def lower_email(c: Column) -> Column:
    return F.lower(strip(c))


def title_case(c: Column) -> Column:
    """Capitalise after white space and punctuation (``mary-ann`` -> ``Mary-Ann``)."""
    special = "".join("\\" + ch for ch in NAME_DELIMITERS)
    words = F.split(F.lower(strip(c)), f"(?<=[\\s\\p{{Z}}{special}])")
    return F.array_join(
        F.transform(
            words,
            lambda w: F.concat(F.upper(w.substr(F.lit(1), F.lit(1))), w.substr(F.lit(2), F.length(w))),
        ),
        "",
    )
