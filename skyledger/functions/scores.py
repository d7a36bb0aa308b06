"""Column functions for error presentation maths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values from the dashboard contract: KPI bands per MAE metric
# (good upper bound, warning upper bound, needle maximum) and the bias domain.
KPI_BANDS = {
    "temperature_mae": (1.0, 2.5, 4.0),
    "temp_min_mae": (1.0, 2.5, 4.0),
    "temp_max_mae": (1.0, 2.5, 4.0),
    "precipitation_mm_mae": (1.0, 3.0, 6.0),
}
BIAS_DOMAIN = 3.0


def kpi_band(value: Column, good: float, warning: float) -> Column:
    """good / warning / poor on ``|v|``; null value -> null band."""
    mag = F.abs(value)
    return F.when(value.isNull(), F.lit(None).cast("string")) \
        .when(mag <= good, F.lit("good")).when(mag <= warning, F.lit("warning")).otherwise(F.lit("poor"))


def needle_position(value: Column, maximum: float) -> Column:
    """``min(|v|, max) / max``, 0 when null (``least`` skips nulls, so guard first)."""
    return F.when(value.isNull(), F.lit(0.0)).otherwise(F.least(F.abs(value), F.lit(maximum)) / F.lit(maximum))


def bias_position(value: Column, domain: float = BIAS_DOMAIN) -> Column:
    """clamp to [-domain, domain], then ``v / domain * 50`` (percent of half track)."""
    clamped = F.greatest(F.lit(-domain), F.least(F.lit(domain), value))
    return F.when(value.isNull(), F.lit(0.0)).otherwise(clamped / F.lit(domain) * F.lit(50.0))


def bias_intensity(value: Column, domain: float = BIAS_DOMAIN) -> Column:
    """``min(|v| / domain, 1)``, 0 when null."""
    return F.when(value.isNull(), F.lit(0.0)).otherwise(F.least(F.abs(value) / F.lit(domain), F.lit(1.0)))


def shown(value: Column) -> Column:
    """two digits for display, halves away from zero; results only, never an intermediate. Null stays null."""
    return F.round(value, 2)
