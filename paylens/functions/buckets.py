"""Searched-CASE banding driven by a :class:`paylens.config.Band`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paylens.config import Band


def _below(value: Column, band: Band, i: int) -> Column:
    edge = F.lit(band.edges[i])
    return value <= edge if band.is_inclusive(i) else value < edge


def band_label(value: Column, band: Band) -> Column:
    expr = None
    for i, label in enumerate(band.labels[:-1]):
        cond = _below(value, band, i)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(band.labels[-1])


def band_ord(value: Column, band: Band) -> Column:
    expr = None
    for i in range(len(band.edges)):
        cond = _below(value, band, i)
        expr = F.when(cond, i + 1) if expr is None else expr.when(cond, i + 1)
    return expr.otherwise(len(band.labels))


def band_ord_ratio(num: Column, den: Column, band: Band) -> Column:
    """Band position of num/den (den > 0) compared without dividing."""
    expr = None
    for i in range(len(band.edges)):
        scaled = den * F.lit(band.edges[i])
        cond = num <= scaled if band.is_inclusive(i) else num < scaled
        expr = F.when(cond, i + 1) if expr is None else expr.when(cond, i + 1)
    return expr.otherwise(len(band.labels))


def label_of(ord_col: Column, band: Band) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in band.labels]), ord_col)
