"""Query registry and the derived input tables the queries share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.timeindex import downsample, regularize
from tidemark.session import prepare


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a ``(spark, sf_dir) -> DataFrame`` function under its own name."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(prepare(spark), sf_dir))

        REGISTRY[fn.__name__] = Query(fn.__name__, run, sql)
        return fn

    return add


# Added before rounding where exact half-way values occur (means of two-decimal prices):
# otherwise the last digit would depend on the order of summation.
NUDGE = 3e-9


def rounded(df: DataFrame, *columns: str, digits: int = 6, nudge: bool = False) -> DataFrame:
    shift = NUDGE if nudge else 0.0
    return df.withColumns({c: F.round(F.col(c) + shift if nudge else F.col(c), digits) for c in columns})


class Tables:
    """Base tables and the derived series H, G, D, O and L.

    * ``hourly``  - mean event value per event type and hour (absent hours are holes)
    * ``grid``    - ``hourly`` with the absent hours inserted as nulls
    * ``gappy``   - ``grid`` with low values and three whole days removed
    * ``bars``    - daily open/high/low/close of event values per event type
    * ``daily``   - orders per priority and day
    * ``weather`` - line items read as weather measurements
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def events(self) -> DataFrame:
        return self.read("events")

    def hourly(self) -> DataFrame:
        e = self.events().withColumnRenamed("event_type", "series_id")
        return downsample(e, "1 hour", {"value": F.avg("value")})

    def grid(self) -> DataFrame:
        return regularize(self.hourly(), "1 hour").drop("is_filled")

    def gappy(self) -> DataFrame:
        keep = (F.col("value") >= 45) & ~F.dayofmonth("ts").between(10, 12)
        return self.grid().withColumn("value", F.when(keep, F.col("value")))

    def bars(self) -> DataFrame:
        e = self.events().withColumnRenamed("event_type", "ticker")
        first = F.struct("ts", "event_id")
        return downsample(
            e, "1 day",
            {
                "open": F.min_by("value", first), "high": F.max("value"), "low": F.min("value"),
                "close": F.max_by("value", first), "volume": F.count("*").cast("double"),
            },
            keys=["ticker"],
        )

    def daily(self) -> DataFrame:
        o = self.read("orders").select(F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").alias("ts"), "o_totalprice")
        return downsample(o, "1 day", {"value": F.sum("o_totalprice"), "n": F.count("*")})

    def weather(self) -> DataFrame:
        return self.read("lineitem").select(
            "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("ts"),
            (F.col("l_quantity") - 20.0).alias("meteo_temperature_2m"),
            (F.col("l_discount") * 1000.0).alias("meteo_relative_humidity_2m"),
            (F.col("l_tax") * 100.0).alias("meteo_wind_speed_10m"),
            F.col("l_extendedprice").alias("meteo_shortwave_radiation"),
            F.col("l_tax").alias("meteo_cloudcover"),
        )


def hours(n: str | int) -> Column:
    return F.expr(f"INTERVAL {n} HOURS")


CTE = {
    "h": "h AS (SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, avg(value) AS value FROM events GROUP BY 1, 2)",
    "g": """gb AS (SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM h GROUP BY 1),
gt AS (SELECT series_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM gb),
g AS (SELECT gt.series_id, gt.ts, h.value FROM gt LEFT JOIN h ON h.series_id = gt.series_id AND h.ts = gt.ts)""",
    "gg": """gg AS (SELECT series_id, ts, CASE WHEN value >= 45 AND NOT day(ts) BETWEEN 10 AND 12 THEN value END AS value FROM g)""",
    "d": """d AS (SELECT event_type AS ticker, date_trunc('day', ts) AS ts, arg_min(value, ts) AS open, max(value) AS high,
min(value) AS low, arg_max(value, ts) AS close, CAST(count(*) AS DOUBLE) AS volume FROM events GROUP BY 1, 2)""",
    "o": """o AS (SELECT o_orderpriority AS series_id, date_trunc('day', o_orderdate) AS ts, sum(o_totalprice) AS value,
count(*) AS n FROM orders GROUP BY 1, 2)""",
    "l": """l AS (SELECT l_orderkey, l_linenumber, l_shipdate AS ts, l_quantity - 20.0 AS meteo_temperature_2m,
l_discount * 1000.0 AS meteo_relative_humidity_2m, l_tax * 100.0 AS meteo_wind_speed_10m,
l_extendedprice AS meteo_shortwave_radiation, l_tax AS meteo_cloudcover FROM lineitem)""",
    # neighbours of every gappy row: position, last and next non-null row
    "nb": """nb0 AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS rn FROM gg),
nb1 AS (SELECT *, max(CASE WHEN value IS NOT NULL THEN rn END) OVER (PARTITION BY series_id ORDER BY rn ROWS UNBOUNDED PRECEDING) AS pr,
min(CASE WHEN value IS NOT NULL THEN rn END) OVER (PARTITION BY series_id ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nr FROM nb0),
nb AS (SELECT a.*, p.value AS pv, p.ts AS pt, q.value AS nv, q.ts AS nt FROM nb1 a
LEFT JOIN nb0 p ON p.series_id = a.series_id AND p.rn = a.pr LEFT JOIN nb0 q ON q.series_id = a.series_id AND q.rn = a.nr)""",
    "nb_interp": """it AS (SELECT *, CASE WHEN value IS NOT NULL THEN value WHEN pr IS NULL OR rn - pr > 6 THEN NULL WHEN nr IS NULL THEN pv
ELSE pv + (nv - pv) * ((epoch_us(ts) - epoch_us(pt))::DOUBLE / (epoch_us(nt) - epoch_us(pt))) END AS iv FROM nb)""",
}


def with_cte(*names: str, more: str = "") -> str:
    parts = [CTE[n] for n in names]
    if more:
        parts.append(more)
    return "WITH " + ",\n".join(parts) + "\n"
