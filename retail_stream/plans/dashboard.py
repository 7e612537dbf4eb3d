"""Dashboard answers from the stored tables of daily active devices and of first days. Each reads the folders
of the days it is asked for and no others."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_stream.operators import counts
from retail_stream.sinks import tables


def _active(spark: SparkSession, path: str, *days: str) -> DataFrame:
    return tables.read_table(spark, tables.DAU, path, days=list(days), columns=("log_hour",))


def _day_and_before(date: str) -> list[str]:
    try:
        return [date, (dt.date.fromisoformat(date) - dt.timedelta(days=1)).isoformat()]
    except ValueError:
        return [date]


def dau_total(spark: SparkSession, path: str, date: str) -> DataFrame:
    """The day's number of active devices."""
    return counts.dau_total(_active(spark, path, date), date)


def dau_hourly(spark: SparkSession, path: str, date: str) -> DataFrame:
    """The day's active devices by hour."""
    return counts.dau_hourly(_active(spark, path, date), date)


def new_devices(spark: SparkSession, first_days_path: str, date: str) -> DataFrame:
    """Devices whose first active day is ``date``."""
    rows = tables.read_table(spark, tables.FIRST_DAYS, first_days_path, days=[date], columns=("present",))
    return rows.agg(F.count_if("present").alias("new_mids"))


def realtime_total(spark: SparkSession, path: str, first_days_path: str, date: str) -> DataFrame:
    """The day's total and its new devices as one JSON row."""
    return counts.totals_json(dau_total(spark, path, date), new_devices(spark, first_days_path, date))


def realtime_hours(spark: SparkSession, path: str, id: str, date: str) -> DataFrame:
    """Hour maps of the day and the day before as one JSON row."""
    return counts.realtime_hours(_active(spark, path, *_day_and_before(date)), id, date)
