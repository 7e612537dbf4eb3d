"""Messages of each topic as finished records."""

from __future__ import annotations

from pyspark.sql import DataFrame

from retail_stream import schemas
from retail_stream.functions import columns as C
from retail_stream.functions import records


def _arrival(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c == "arrival_ts"]


def startup_logs(raw: DataFrame) -> DataFrame:
    logs = records.with_log_time(records.parse(raw, schemas.STARTUP))
    return logs.select(*schemas.STARTUP_COLUMNS, *_arrival(raw))


def event_logs(raw: DataFrame) -> DataFrame:
    logs = records.with_log_time(records.parse(raw, schemas.EVENT))
    return logs.select(*schemas.EVENT_COLUMNS, *_arrival(raw))


def orders(raw: DataFrame) -> DataFrame:
    """Orders with date and hour columns and a masked phone number."""
    parsed = records.with_create_time(records.parse(raw, schemas.ORDER))
    masked = parsed.withColumn("consignee_tel", C.mask_phone("consignee_tel"))
    return masked.select(*schemas.ORDER_COLUMNS, *_arrival(raw))


def details(raw: DataFrame) -> DataFrame:
    return records.parse(raw, schemas.DETAIL).select(*schemas.DETAIL_COLUMNS, *_arrival(raw))


def users(raw: DataFrame) -> DataFrame:
    return records.parse(raw, schemas.USER).select(*schemas.USER_COLUMNS, *_arrival(raw))
