"""Scalar expressions for scores, bins, labels and calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnlake.schema import (
    CONTRACT_FACTOR_DEFAULT, CONTRACT_FACTORS, EDA_TENURE_EDGES, EDA_TENURE_LABELS,
    SCORE_BASE, SCORE_CHARGE_SCALE, SCORE_CHARGE_W, SCORE_CLIP, SCORE_CONTRACT_W,
    SCORE_TENURE_SCALE, SCORE_TENURE_W, TENURE_GROUP_EDGES, TENURE_GROUP_LABELS,
)


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clip(col: str | Column, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), _c(col)))


def contract_factor(col: str | Column = "Contract") -> Column:
    """Contract type -> risk factor, unmapped or null -> default."""
    expr = None
    for name, factor in CONTRACT_FACTORS.items():
        cond = _c(col) == name
        expr = F.when(cond, F.lit(factor)) if expr is None else expr.when(cond, F.lit(factor))
    return expr.otherwise(F.lit(CONTRACT_FACTOR_DEFAULT))


def heuristic_score(tenure: str | Column = "tenure", charges: str | Column = "MonthlyCharges",
                    contract: str | Column = "Contract") -> Column:
    """Deterministic churn-risk score clipped to [0.01, 0.99] (inputs already filled)."""
    raw = (
        F.lit(SCORE_BASE)
        + (F.lit(1.0) - _c(tenure).cast("double") / SCORE_TENURE_SCALE) * SCORE_TENURE_W
        + (_c(charges).cast("double") / SCORE_CHARGE_SCALE) * SCORE_CHARGE_W
        + (contract_factor(contract) - F.lit(1.0)) * SCORE_CONTRACT_W
    )
    return clip(raw, *SCORE_CLIP)


def right_closed_bins(col: str | Column, edges: list[float], labels: list[str],
                      open_top: bool = False) -> Column:
    """Label of the right-closed bin (e_i, e_{i+1}] holding the value; outside -> null.

    With ``open_top`` the last label covers (e_last, +inf).
    """
    c = _c(col)
    expr = None
    bounds = list(zip(edges[:-1], edges[1:]))
    for (lo, hi), label in zip(bounds, labels):
        cond = (c > lo) & (c <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if open_top:
        cond = c > edges[-1]
        expr = expr.when(cond, F.lit(labels[len(bounds)]))
    return expr


def tenure_group(col: str | Column = "tenure") -> Column:
    """Model tenure groups (0,12] .. (72,inf); tenure 0 or null -> null."""
    return right_closed_bins(col, TENURE_GROUP_EDGES, TENURE_GROUP_LABELS, open_top=True)


def eda_tenure_bin(col: str | Column = "tenure") -> Column:
    """Exploration tenure bins (0,12], (12,24], (24,48], (48,73]."""
    return right_closed_bins(col, EDA_TENURE_EDGES, EDA_TENURE_LABELS)


def month_label(col: str | Column) -> Column:
    """Abbreviated month name ('Apr'); carry the month date beside it to avoid mixing years."""
    return F.date_format(_c(col), "MMM")


def label_is_yes(col: str | Column = "Churn") -> Column:
    """Raw label text equal to 'Yes' (case-sensitive) -> 1, anything else incl. null -> 0."""
    return (F.coalesce(_c(col), F.lit("")) == "Yes").cast("int")


def label_map(col: str | Column = "Churn") -> Column:
    """{'No': 0, 'Yes': 1}, anything else -> null."""
    c = _c(col)
    return F.when(c == "Yes", F.lit(1)).when(c == "No", F.lit(0)).cast("int")
