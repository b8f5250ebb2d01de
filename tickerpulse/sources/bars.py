"""Price bars: read the collector's JSON and normalise to year-less keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.timeparts import hour_of_hhmm


def read_bars(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Read raw bars (``ticker, date, time, open, high, low, close, volume``)."""
    return (spark.read.schema(schemas.BAR_RAW).option("multiLine", multi_line)
            .option("mode", "PERMISSIVE").json(path))


def normalise_hourly(bars: DataFrame) -> DataFrame:
    """Hourly bars to ``ticker, date, month, day, hour, OHLCV`` (date kept for the year)."""
    d = F.to_date("date")
    return bars.select(
        "ticker", d.alias("date"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
        hour_of_hhmm(F.col("date"), F.col("time")).alias("hour"),
        "open", "high", "low", "close", "volume")


def normalise_daily(bars: DataFrame) -> DataFrame:
    """Daily bars to ``ticker, date, month, day, OHLCV``."""
    d = F.to_date("date")
    return bars.select(
        "ticker", d.alias("date"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
        "open", "high", "low", "close", "volume")
