"""Calendar columns of a time column (plain expressions, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cycle(value: Column, period: float, name: str) -> list[Column]:
    angle = F.lit(2.0) * F.pi() * value / F.lit(float(period))
    return [F.sin(angle).alias(f"{name}_sin"), F.cos(angle).alias(f"{name}_cos")]


def cyclic_columns(ts: str = "ts") -> list[Column]:
    """sin/cos of hour, weekday (Monday = 0), month and day of year."""
    return [
        *_cycle(F.hour(ts), 24, "hour"),
        *_cycle(F.weekday(ts), 7, "dow"),
        *_cycle(F.month(ts), 12, "month"),
        *_cycle(F.dayofyear(ts), 365.25, "doy"),
    ]


def flag_columns(ts: str = "ts") -> list[Column]:
    hour = F.hour(ts)

    def within(lo: int, hi: int) -> Column:
        return ((hour >= lo) & (hour < hi)).cast("int")

    return [
        (F.weekday(ts) >= 5).cast("int").alias("is_weekend"),
        within(6, 20).alias("is_daytime"),
        within(6, 12).alias("is_morning"),
        within(12, 18).alias("is_afternoon"),
    ]


def season_column(ts: str = "ts") -> Column:
    """Winter 0, spring 1, summer 2, autumn 3 (northern hemisphere)."""
    return F.floor((F.month(ts) % 12) / 3).cast("int").alias("season")


def add_time_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.select("*", *cyclic_columns(ts), *flag_columns(ts), season_column(ts))
