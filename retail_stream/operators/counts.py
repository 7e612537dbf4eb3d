"""Dashboard counts over the table of daily active devices, one row per (log_date, mid)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_stream.functions import columns as C

# --- Fixed values: ids and labels of the dashboard ---------------------------------------------
DAU_ID = "dau"
DAU_LABEL = "新增日活"
NEW_ID = "new_mid"
NEW_LABEL = "新增设备"
# --- end of fixed values -----------------------------------------------------------------------


def dau_total(dau: DataFrame, date: str) -> DataFrame:
    """Active devices of a day; 0 for a day without any."""
    return dau.filter(F.col("log_date") == date).agg(F.count("*").alias("total"))


def dau_hourly(dau: DataFrame, date: str) -> DataFrame:
    """Active devices by hour of first start; hours without any are absent."""
    return dau.filter(F.col("log_date") == date).groupBy("log_hour").agg(F.count("*").alias("ct"))


def _hour_map(hour: Column, count: Column) -> Column:
    """Hour to count, in hour order. At most 24 entries; null hours and counts are left out."""
    entry = F.when(hour.isNotNull() & count.isNotNull(), F.struct(hour.alias("k"), count.alias("v")))
    return F.map_from_entries(F.sort_array(F.collect_list(entry)))


def dau_hour_map(dau: DataFrame, date: str) -> DataFrame:
    """``dau_hourly`` as one map."""
    hourly = dau_hourly(dau, date)
    return hourly.agg(_hour_map(F.col("log_hour"), F.col("ct")).alias("hours"))


def _first_days(dau: DataFrame, date: str) -> DataFrame:
    """Per device: its first day up to ``date`` and whether it was active on ``date``. Dates rather
    than texts keep this a hash aggregate."""
    day = F.col("log_date").try_cast("date")
    return (
        dau.filter(F.col("log_date") <= date)
        .groupBy("mid")
        .agg(F.min(day).alias("first_day"), F.count_if(F.col("log_date") == date).alias("active"))
    )


def _is_day(date: str) -> Column:
    return F.col("first_day") == F.lit(date).try_cast("date")


def new_devices(dau: DataFrame, date: str) -> DataFrame:
    """Devices whose first active day is ``date``."""
    return _first_days(dau, date).agg(F.count_if(_is_day(date)).alias("new_mids"))


def realtime_total(dau: DataFrame, date: str) -> DataFrame:
    """One row, ``json``: an array of the day's total and its new devices."""
    totals = _first_days(dau, date).agg(
        F.coalesce(F.sum("active"), F.lit(0)).alias("total"),
        F.count_if(_is_day(date)).alias("new_mids"),
    )

    return totals.select(_totals_text().alias("json"))


def _totals_text() -> Column:
    def item(id_: str, label: str, value: str) -> Column:
        return F.struct(
            F.lit(id_).alias("id"), F.lit(label).alias("name"), F.col(value).alias("value")
        )

    return F.to_json(F.array(item(DAU_ID, DAU_LABEL, "total"), item(NEW_ID, NEW_LABEL, "new_mids")))


def totals_json(total: DataFrame, new: DataFrame) -> DataFrame:
    """``realtime_total`` from one row with the day's ``total`` and one with its ``new_mids``."""
    both = total.select("total").unionByName(new.select("new_mids"), allowMissingColumns=True)
    return both.agg(F.max("total").alias("total"), F.max("new_mids").alias("new_mids")).select(_totals_text().alias("json"))


def hours_today_yesterday(dau: DataFrame, date: str) -> DataFrame:
    """Hourly counts of a day and of the day before, side by side; 0 where one has none."""
    before = C.previous_day(date)
    today = F.col("log_date") == date
    yesterday = F.col("log_date") == before
    return (
        dau.filter(today | yesterday)
        .groupBy("log_hour")
        .agg(F.count_if(yesterday).alias("yesterday"), F.count_if(today).alias("today"))
    )


def realtime_hours(dau: DataFrame, id: str, date: str) -> DataFrame:
    """One row, ``json``: hour maps ``yesterday`` and ``today`` of the metric."""
    if id != DAU_ID:
        raise ValueError(f"unknown metric: {id!r}")
    pair = hours_today_yesterday(dau, date)
    maps = pair.agg(
        *[
            _hour_map(F.when(F.col(d) > 0, F.col("log_hour")), F.col(d)).alias(d)
            for d in ("yesterday", "today")
        ]
    )
    return maps.select(F.to_json(F.struct("yesterday", "today")).alias("json"))
