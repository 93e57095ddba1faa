"""Robust statistics as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def robust_thresholds(df: DataFrame, by: list[str], value: str, minimum: float, cap: float = 65.0) -> DataFrame:
    """``median + 4 * max(1, 1.4826 * MAD)`` of each group, at least ``minimum``, at most ``cap``."""
    middle = df.groupBy(*by).agg(F.expr(f"percentile({value}, 0.5)").alias("_m"))
    away = df.join(middle, by).groupBy(*by).agg(F.first("_m").alias("median"), F.expr(f"percentile(abs({value} - _m), 0.5)").alias("mad"))
    limit = F.col("median") + 4 * F.greatest(F.lit(1.0), 1.4826 * F.col("mad"))
    return away.withColumn("threshold", F.least(F.lit(cap), F.greatest(F.lit(minimum), limit)))


# Fixed value: by how much an interpolated quantile may miss a distance that it stands for.
SLACK = 1e-9


def coherent_medians(df: DataFrame, by: list[str], value: str, share: float = 0.7, floor: float = 2.0) -> DataFrame:
    """Median of the values of each group that lie within the ``share`` quantile of distances to the median (or ``floor``)."""
    middle = df.groupBy(*by).agg(F.expr(f"percentile({value}, 0.5)").alias("_m"))
    near = df.join(middle, by).withColumn("_d", F.abs(F.col(value) - F.col("_m")))
    cut = near.groupBy(*by).agg(F.expr(f"percentile(_d, {share})").alias("_cut"))
    kept = near.join(cut, by).where(F.col("_d") <= F.greatest(F.lit(floor), F.col("_cut") + SLACK))
    return kept.groupBy(*by).agg(F.expr(f"percentile({value}, 0.5)").alias("fill"), F.count("*").alias("kept"))


def channel_medians(df: DataFrame, by: list[str], channels: list[str]) -> DataFrame:
    """Median of each channel of each group, rounded half to even."""
    return df.groupBy(*by).agg(*[F.rint(F.expr(f"percentile({c}, 0.5)")).cast("int").alias(c) for c in channels])


def non_negative_rest(total: Column, part: Column) -> Column:
    return F.greatest(F.lit(0), total - part)
