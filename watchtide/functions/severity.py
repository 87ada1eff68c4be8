"""Severity bands and the points they give to risk scores."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from watchtide.functions.text import points

# Lower bound of each band, and the points a band adds to a risk score.
BANDS = (("Critical", 9.0), ("High", 7.0), ("Medium", 4.0), ("Low", 1.0))
BAND_POINTS = (("Critical", 40), ("High", 30), ("Medium", 20), ("Low", 10))


def _banded(score: Column) -> Column:
    chain = F
    for label, floor in BANDS:
        chain = chain.when(score >= F.lit(floor), F.lit(label))
    return chain


def severity_level(score: Column) -> Column:
    """Band of a sanitised score; zero and below is ``Unknown``."""
    return _banded(score).when(score > F.lit(0.0), F.lit("Informational")).otherwise(F.lit("Unknown"))


def severity_level_flat(score: Column) -> Column:
    """Band used by the flat record, where everything below Low is ``Informational``."""
    return _banded(score).otherwise(F.lit("Informational"))


def severity_points(level: Column, *extra) -> Column:
    """Risk score: points of the band plus the ``(condition, points)`` extras that hold."""
    return points(*[(level == F.lit(label), value) for label, value in BAND_POINTS], *extra)
