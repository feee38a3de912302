"""Column expressions for reading a score: calibration, lift, bands and verdicts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: cut points, highest first ---------------------------------------------
LIFT_BANDS = [(100.0, "critical"), (30.0, "high"), (10.0, "elevated"), (3.0, "low")]
ABSOLUTE_BANDS = [(0.90, "critical"), (0.70, "high"), (0.40, "elevated"), (0.15, "low")]
RATE_SEVERITY = [(0.3, "critical"), (0.1, "elevated")]
HISTOGRAM_BANDS = ["minimal", "low", "elevated", "high", "critical"]
HISTOGRAM_EDGES = [0.15, 0.40, 0.70, 0.90]
HISTOGRAM_RANGE = (-0.001, 1.001)
AMOUNT_EDGES = [10, 25, 50, 100, 250, 500, 1000]
DEFAULT_BASE_RATE = 0.00165
DEFAULT_THRESHOLD_LIFT = 30.0
# ------------------------------------------------------------------------------------------


def _col(value: Column | float) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def _ladder(c: Column, rungs: Sequence[tuple[float, str]], floor: str) -> Column:
    """First rung whose cut the value reaches, else the floor."""
    (cut, name), *rest = rungs
    chain = F.when(c >= cut, F.lit(name))
    for cut, name in rest:
        chain = chain.when(c >= cut, F.lit(name))
    return chain.otherwise(F.lit(floor))


def calibrate(p: Column, base_rate: Column | float) -> Column:
    """Move a score learnt on balanced classes back to the real base rate."""
    base = _col(base_rate)
    low, high = F.lit(1e-9), F.lit(1 - 1e-9)
    bounded = F.when(p < low, low).when(p > high, high).otherwise(p)
    odds = bounded / (1 - bounded) * (base / (1 - base))
    return odds / (1 + odds)


def lift(p: Column, base_rate: Column | float) -> Column:
    return F.coalesce(F.try_divide(p, _col(base_rate)), F.lit(0.0))


def risk_band(p: Column, base_rate: Column | float) -> Column:
    return _ladder(lift(p, base_rate), LIFT_BANDS, "minimal")


def absolute_risk_band(p: Column) -> Column:
    return _ladder(p, ABSOLUTE_BANDS, "minimal")


def verdict(p: Column, base_rate: Column | float, threshold_lift: float = DEFAULT_THRESHOLD_LIFT) -> Column:
    cutoff = _col(base_rate) * F.lit(float(threshold_lift))
    return F.when(p >= cutoff, F.lit("REVIEW")).otherwise(F.lit("CLEAR"))


def rate_severity(rate_pct: Column) -> Column:
    top, middle = RATE_SEVERITY
    return (
        F.when(rate_pct > top[0], F.lit(top[1]))
        .when(rate_pct > middle[0], F.lit(middle[1]))
        .otherwise(F.lit("normal"))
    )


def histogram_band(p: Column) -> Column:
    """Right-closed bins of the live page; null outside the outer edges."""
    low, high = HISTOGRAM_RANGE
    inside = (p > low) & (p <= high)
    chain = F.when(~inside | p.isNull(), F.lit(None).cast("string"))
    for edge, name in zip(HISTOGRAM_EDGES, HISTOGRAM_BANDS):
        chain = chain.when(p <= edge, F.lit(name))
    return chain.otherwise(F.lit(HISTOGRAM_BANDS[-1]))


def amount_bucket_order(amount: Column) -> Column:
    """0-based position of the half-open amount range, for natural ordering."""
    chain = F.when(amount < AMOUNT_EDGES[0], F.lit(0))
    for position, edge in enumerate(AMOUNT_EDGES[1:], start=1):
        chain = chain.when(amount < edge, F.lit(position))
    return chain.otherwise(F.lit(len(AMOUNT_EDGES)))


def amount_labels() -> list[str]:
    lows = [0, *AMOUNT_EDGES[:-1]]
    return [f"{low}-{high}" for low, high in zip(lows, AMOUNT_EDGES)] + [f"{AMOUNT_EDGES[-1]}+"]


def amount_bucket(amount: Column) -> Column:
    labels = F.array(*[F.lit(name) for name in amount_labels()])
    return F.get(labels, amount_bucket_order(amount))


def percent(part: Column, whole: Column, digits: int = 4) -> Column:
    return F.round(F.lit(100.0) * part / whole, digits)
