"""Declarative validation rules evaluated in as few aggregates as possible."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.blocks import CELL, cell_scan
from tidemark.operators.timeindex import gaps

REPORT = "check_name string, passed boolean, observed double, threshold double, critical boolean"


@dataclass(frozen=True)
class Rule:
    column: str
    low: float
    high: float
    max_null: float


# Physical bounds and tolerated null share per weather variable.
WEATHER_RULES = (
    Rule("meteo_temperature_2m", -60.0, 60.0, 0.02),
    Rule("meteo_relative_humidity_2m", 0.0, 100.0, 0.02),
    Rule("meteo_wind_speed_10m", 0.0, 250.0, 0.05),
    Rule("meteo_precipitation", 0.0, 500.0, 0.05),
    Rule("meteo_surface_pressure", 870.0, 1085.0, 0.05),
    Rule("meteo_shortwave_radiation", 0.0, 1400.0, 0.10),
)
MIN_SHARE = 0.99
MIN_DAYS = 365
MAX_GAP_HOURS = 24.0
MARKET_MAX_NULL = 0.20


def _check(name: str | Column, passed: Column, observed: Column, threshold: float, critical: bool = False) -> Column:
    return F.struct(
        (F.lit(name) if isinstance(name, str) else name).alias("check_name"),
        passed.alias("passed"),
        observed.cast("double").alias("observed"),
        F.lit(float(threshold)).alias("threshold"),
        F.lit(critical).alias("critical"),
    )


def _long(df: DataFrame, checks: Sequence[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*checks)))


def column_checks(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Presence, type, range share and null share of every rule column: one aggregate."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    aggs: list[Column] = [F.count("*").alias("n")]
    checks: list[Column] = []
    for r in rules:
        present = r.column in fields
        flag = F.lit(1.0 if present else 0.0)
        checks.append(_check(f"column_exists_{r.column}", F.lit(present), flag, 1.0, critical=True))
        if not present:
            continue
        numeric = isinstance(fields[r.column], T.NumericType) and not isinstance(fields[r.column], T.DecimalType)
        checks.append(_check(f"numeric_{r.column}", F.lit(numeric), F.lit(float(numeric)), 1.0))
        c = F.col(r.column)
        aggs.append(F.avg(c.between(r.low, r.high).cast("int")).alias(f"in_{r.column}"))
        aggs.append(F.avg(c.isNull().cast("int")).alias(f"null_{r.column}"))
        share = F.coalesce(F.col(f"in_{r.column}"), F.lit(0.0))
        nulls = F.coalesce(F.col(f"null_{r.column}"), F.lit(0.0))
        checks.append(_check(f"range_{r.column}", share >= MIN_SHARE, share, MIN_SHARE))
        checks.append(_check(f"nulls_{r.column}", nulls <= r.max_null, nulls, r.max_null))
    return _long(df.agg(*aggs), checks)


def time_unique(df: DataFrame, *, keys: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """No (series, time) twice; copies are combined before the shuffle."""
    counted = df.groupBy(*keys, ts).agg(F.count("*").alias("c"))
    row = counted.agg(F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c") - 1)), F.lit(0)).alias("d"))
    return _long(row, [_check("index_unique", F.col("d") == 0, F.col("d"), 0.0, critical=True)])


def time_monotonic(
    df: DataFrame, order: str, *, keys: Sequence[str] = (), ts: str = "ts", width: float = 1_000_000.0
) -> DataFrame:
    """Time never decreases in the stored order given by the numeric column ``order``."""
    back = cell_scan(
        df.select(*keys, ts, order), keys, order, cell=width, numeric=True,
        prev={"__before": F.col(ts)}, exclusive=True,
    )
    row = back.agg(F.count_if(F.col(ts) < F.col("__before")).alias("d"))
    return _long(row, [_check("index_monotonic", F.col("d") == 0, F.col("d"), 0.0, critical=True)])


def time_type(df: DataFrame, ts: str = "ts") -> DataFrame:
    """The time column is a timestamp (schema check carried on one aggregate row)."""
    ok = isinstance(df.schema[ts].dataType, (T.TimestampType, T.TimestampNTZType))
    row = df.agg(F.count(ts).alias("n"))
    return _long(row, [_check("index_datetime", F.lit(ok), F.lit(float(ok)), 1.0, critical=True)])


def coverage(df: DataFrame, *, ts: str = "ts", min_days: int = MIN_DAYS) -> DataFrame:
    """At least ``min_days`` whole days between the first and the last row."""
    row = df.agg(F.floor((F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp"))) / F.lit(86_400_000_000)).alias("d"))
    days = F.coalesce(F.col("d"), F.lit(-1))
    return _long(row, [_check("coverage_days", days >= min_days, days, min_days)])


def max_gap_check(
    df: DataFrame, *, keys: Sequence[str] = (), ts: str = "ts", limit: float = MAX_GAP_HOURS, cell: str | None = CELL
) -> DataFrame:
    row = gaps(df, keys=keys, ts=ts, cell=cell).agg(F.max("max_gap_hours").alias("g"))
    gap = F.coalesce(F.col("g"), F.lit(0.0))
    return _long(row, [_check("max_gap_hours", gap <= limit, gap, limit)])


def validate_weather(
    df: DataFrame,
    rules: Sequence[Rule] = WEATHER_RULES,
    *,
    keys: Sequence[str] = (),
    ts: str = "ts",
    order: str | None = None,
    cell: str | None = CELL,
) -> DataFrame:
    """Full report for hourly measurements, one row per check.

    The stored-order check needs an ingest sequence column (``order``); a table without
    one has no stored order and the check is left out.
    """
    report = (
        column_checks(df, rules)
        .unionByName(time_unique(df, keys=keys, ts=ts))
        .unionByName(time_type(df, ts))
        .unionByName(coverage(df, ts=ts))
        .unionByName(max_gap_check(df, keys=keys, ts=ts, cell=cell))
    )
    if order:
        report = report.unionByName(time_monotonic(df, order, keys=keys, ts=ts))
    return report


def validate_market(
    df: DataFrame, *, keys: Sequence[str] = (), ts: str = "ts", order: str | None = None
) -> DataFrame:
    """Close prices positive, null share strictly below 20 %, unique and ordered time."""
    closes = [c for c in df.columns if c == "close" or c.endswith("_close")]
    aggs: list[Column] = [F.count("*").alias("n")]
    checks: list[Column] = [_check("data_not_empty", F.col("n") > 0, F.col("n"), 0.0, critical=True)]
    for c in closes:
        aggs.append(F.avg((F.col(c) > 0).cast("int")).alias(f"pos_{c}"))
        aggs.append(F.avg(F.col(c).isNull().cast("int")).alias(f"null_{c}"))
        pos = F.coalesce(F.col(f"pos_{c}"), F.lit(0.0))
        nulls = F.coalesce(F.col(f"null_{c}"), F.lit(1.0))
        checks.append(_check(f"close_positive_{c}", pos >= MIN_SHARE, pos, MIN_SHARE))
        checks.append(_check(f"close_no_nulls_{c}", nulls < MARKET_MAX_NULL, nulls, MARKET_MAX_NULL))
    report = _long(df.agg(*aggs), checks).unionByName(time_unique(df, keys=keys, ts=ts))
    if order:
        report = report.unionByName(time_monotonic(df, order, keys=keys, ts=ts))
    return report


def run_validation(
    weather: DataFrame, market: DataFrame | None = None, *, keys: Sequence[str] = (), ts: str = "ts"
) -> DataFrame:
    """Both reports with a ``source`` column; the market table is optional."""
    out = validate_weather(weather, keys=keys, ts=ts).withColumn("source", F.lit("weather"))
    if market is not None:
        m_keys = [k for k in ("ticker",) if k in market.columns] or list(keys)
        out = out.unionByName(validate_market(market, keys=m_keys, ts=ts).withColumn("source", F.lit("market")))
    return out


def raise_on_critical(report: DataFrame) -> DataFrame:
    """Fail the job when a critical check failed (at most one row per check is read)."""
    failed = [r.check_name for r in report.filter("critical AND NOT passed").select("check_name").collect()]
    if failed:
        raise ValueError("critical checks failed: " + ", ".join(sorted(failed)))
    return report


def production_gate(
    metrics: DataFrame, *, max_rmse: float = 2.5, max_mape: float = 10.0, min_r2: float = 0.80
) -> DataFrame:
    """Adds ``gate_passed``: error bounds and explained share all hold."""
    ok = (F.col("rmse") <= max_rmse) & (F.col("mape") <= max_mape) & (F.col("r2") >= min_r2)
    return metrics.withColumn("gate_passed", ok)
