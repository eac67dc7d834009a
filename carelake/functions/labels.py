"""Code -> label lookups and binning."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.functions._col import as_col

__all__ = ["label", "classify", "bins", "flag"]


def label(c, mapping: dict, default=None, keep: bool = False) -> Column:
    """Look a code up in a literal map.

    Unmapped codes give ``default`` (NULL by default); ``keep=True`` keeps
    the original value instead (pandas ``replace`` semantics, X13).
    """
    col = as_col(c)
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    hit = F.try_element_at(m, col)
    if keep:
        return F.coalesce(hit, col)
    return hit if default is None else F.coalesce(hit, F.lit(default))


def classify(rules, default=None) -> Column:
    """First matching ``(predicate, value)`` wins, else ``default``."""
    expr = None
    for pred, value in rules:
        expr = F.when(pred, F.lit(value)) if expr is None else expr.when(pred, F.lit(value))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def bins(c, edges, labels) -> Column:
    """Right-closed bins, lowest edge included; outside -> NULL.

    ``edges=[0,5,14,44,59,inf]`` gives [0,5], (5,14], (14,44], (44,59], (59,inf).
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need len(edges)-1 labels")
    col = as_col(c)
    expr = F.when((col >= F.lit(edges[0])) & (col <= F.lit(edges[1])), F.lit(labels[0]))
    for lo, hi, lab in zip(edges[1:-1], edges[2:], labels[1:]):
        upper = (col <= F.lit(hi)) if hi != float("inf") else F.lit(True)
        expr = expr.when((col > F.lit(lo)) & upper, F.lit(lab))
    return expr


def flag(pred: Column) -> Column:
    """Boolean -> 0/1 int, NULL predicate -> 0."""
    return F.when(pred, 1).otherwise(0)
