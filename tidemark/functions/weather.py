"""Physical weather indices as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.blocks import attach
from tidemark.operators.quantiles import exact_quantiles

TEMPERATURE = "meteo_temperature_2m"
HUMIDITY = "meteo_relative_humidity_2m"
WIND = "meteo_wind_speed_10m"
RADIATION = "meteo_shortwave_radiation"
CLOUD = "meteo_cloudcover"


def humidex(t: Column, rh: Column) -> Column:
    """Masterton-Richardson humidex over the Magnus vapour pressure."""
    saturation = F.lit(6.112) * F.exp(F.lit(17.67) * t / (t + F.lit(243.5)))
    return t + F.lit(0.5555) * (rh / 100.0 * saturation - 10.0)


def windchill(t: Column, wind: Column) -> Column:
    """Wind chill for t < 10 C and wind > 1.3 m/s, else the temperature itself."""
    v = F.pow(F.greatest(wind, F.lit(0.0)) * 3.6, F.lit(0.16))
    felt = F.lit(13.12) + F.lit(0.6215) * t - F.lit(11.37) * v + F.lit(0.3965) * t * v
    return F.when((t < 10) & (wind > 1.3), felt).otherwise(t)


def apparent(t: Column, rh: Column, wind: Column) -> Column:
    return F.when(t > 27, humidex(t, rh)).when(t < 10, windchill(t, wind)).otherwise(t)


def add_weather_indices(df: DataFrame) -> DataFrame:
    """Humidex, wind chill and apparent temperature; no-op without temperature or humidity."""
    if TEMPERATURE not in df.columns or HUMIDITY not in df.columns:
        return df
    t, rh = F.col(TEMPERATURE), F.col(HUMIDITY)
    wind = F.col(WIND) if WIND in df.columns else F.lit(0.0)
    return df.select(
        "*",
        humidex(t, rh).alias("meteo_humidex"),
        windchill(t, wind).alias("meteo_windchill"),
        apparent(t, rh, wind).alias("meteo_apparent_temp"),
    )


def add_radiation_norm(df: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """Radiation over its exact 99.9 % quantile, clipped to [0, 1].

    ``fit_on`` restricts the quantile to other rows (for example the training split).
    """
    if RADIATION not in df.columns:
        return df
    source = fit_on if fit_on is not None else df
    top = exact_quantiles(source, [RADIATION], [0.999]).select(F.col("q")[0].alias("__top"))
    share = F.col(RADIATION) / (F.col("__top") + F.lit(1e-8))
    clipped = F.when(share < 0, 0.0).when(share > 1, 1.0).otherwise(share)
    return attach(df, top).select(*df.columns, clipped.alias("meteo_radiation_norm"))


def add_interactions(df: DataFrame) -> DataFrame:
    """Temperature x humidity, temperature x wind, radiation x clear sky (where present)."""
    have = set(df.columns)
    extra = []
    if {TEMPERATURE, HUMIDITY} <= have:
        extra.append((F.col(TEMPERATURE) * F.col(HUMIDITY) / 100.0).alias("interaction_temp_x_hum"))
    if {TEMPERATURE, WIND} <= have:
        extra.append((F.col(TEMPERATURE) * F.col(WIND)).alias("interaction_temp_x_wind"))
    if {RADIATION, CLOUD} <= have:
        extra.append((F.col(RADIATION) * (1 - F.col(CLOUD) / 100.0)).alias("interaction_rad_x_cloud"))
    return df.select("*", *extra)
