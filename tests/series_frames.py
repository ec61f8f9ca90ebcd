"""Hourly frames the tests build their series from."""

import numpy as np
import pandas as pd
import pyarrow as pa


def frame(spark, values, series="a", start="2024-01-01", **more):
    """Hourly series as a DataFrame (NaN becomes null)."""
    n = len(values)
    table = {
        "series_id": pa.array([series] * n, pa.string()),
        "ts": pa.array(pd.date_range(start, periods=n, freq="h").values.astype("datetime64[us]")),
        "value": pa.array(np.asarray(values, dtype=float), from_pandas=True),
    }
    for name, col in more.items():
        table[name] = pa.array(np.asarray(col, dtype=float), from_pandas=True)
    df = spark.createDataFrame(pa.table(table))
    return df.withColumn("ts", df["ts"].cast("timestamp_ntz"))


def column(df, name):
    return df.orderBy("series_id", "ts").toPandas()[name].astype(float).to_numpy()
