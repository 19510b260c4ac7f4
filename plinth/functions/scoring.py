"""Confidence, occupancy and risk as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HIGH, MEDIUM, LOW = 1.0, 0.6, 0.3
#: The seven occupancy classes.
CLASSES = ["Residential", "Commercial", "Industrial", "Agriculture", "Religion", "Government", "Education"]
#: The structure inventory's codes by class.
CODES = {
    "Residential": ["RES1", "RES2", "RES3A", "RES3B", "RES3C", "RES3D", "RES3E", "RES3F", "RES4", "RES5", "RES6"],
    "Commercial": [f"COM{i}" for i in range(1, 11)],
    "Industrial": [f"IND{i}" for i in range(1, 7)],
    "Agriculture": ["AGR1"],
    "Religion": ["REL1"],
    "Government": ["GOV1", "GOV2"],
    "Education": ["EDU1", "EDU2"],
}


def confidence(has_overture: Column, has_fema: Column, iou: Column, high_iou: float = 0.80) -> Column:
    """1.0 if both agree with iou >= high_iou, 0.3 for the second source alone, else 0.6."""
    return F.when(has_overture & has_fema & (iou >= high_iou), HIGH).when(~has_overture & has_fema, LOW).otherwise(MEDIUM)


def iou_for_confidence(has_fema: Column, iou: Column) -> Column:
    return F.when(has_fema, F.coalesce(iou, F.lit(0.0))).otherwise(0.0)


def structure_risk(has_nsi: Column, has_overture: Column, has_fema: Column) -> Column:
    """A structure point that neither footprint source confirms."""
    return has_nsi & ~(has_overture | has_fema)


def occupancy_class(code: Column) -> Column:
    """The class of a structure code, in any case; null for null, blank and unknown codes."""
    out = None
    for name, codes in CODES.items():
        test = F.upper(code).isin(codes)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


def _fema_class(fema: Column) -> Column:
    return F.when(F.trim(fema) != "", fema)


def general_occupancy(fema: Column, code: Column) -> Column:
    return F.coalesce(_fema_class(fema), occupancy_class(code))


def occupancy_confidence(fema: Column, code: Column) -> Column:
    """1.0 agree, 0.8 the footprint's class alone, 0.6 the code alone, 0.3 they differ, null neither."""
    f, n = _fema_class(fema), occupancy_class(code)
    return F.when(f.isNotNull() & n.isNotNull(), F.when(f == n, 1.0).otherwise(0.3)).when(f.isNotNull(), 0.8).when(n.isNotNull(), 0.6)


def confidence_summary(df: DataFrame, column: str = "conflation_confidence") -> DataFrame:
    """One row: total, high, medium, low and their shares in percent (one decimal, 0.0 of nothing)."""
    counts = df.agg(F.count("*").alias("total"), *(F.count_if(F.col(column) == v).alias(n) for n, v in (("high", HIGH), ("medium", MEDIUM), ("low", LOW))))
    share = lambda c: F.when(F.col("total") > 0, F.floor(F.col(c) * 1000.0 / F.col("total") + 0.5) / 10.0).otherwise(0.0)
    return counts.select("*", *(share(c).alias(f"pct_{c}") for c in ("high", "medium", "low")))
