"""Scalar functions on columns. All are built-in SQL expressions and none raises on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from retail_stream import schemas

# --- Fixed values ------------------------------------------------------------------------------
DATE_FORMAT = "yyyy-MM-dd"
HOUR_FORMAT = "HH"
PHONE_VISIBLE = 4
PHONE_STARS = "*******"
DAYS_PER_YEAR = 365
STARTUP_MARK = "startup"
# --- end of fixed values -----------------------------------------------------------------------

# 9999-12-31T23:59:59.999Z: the largest instant whose year still prints with four digits.
MAX_EPOCH_MS = 253402300799999


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms(c: Column | str) -> Column:
    """Text to epoch milliseconds; null when it is no number or lies outside 1970..9999."""
    ms = _col(c).try_cast("bigint")
    return F.when(ms.between(0, MAX_EPOCH_MS), ms)


def event_time(ts: Column | str) -> Column:
    return F.timestamp_millis(_col(ts))


def log_date(ts: Column | str) -> Column:
    """Epoch milliseconds to ``yyyy-MM-dd`` in the session time zone."""
    return F.date_format(event_time(ts), DATE_FORMAT)


def log_hour(ts: Column | str) -> Column:
    """Epoch milliseconds to a two-digit hour in the session time zone."""
    return F.date_format(event_time(ts), HOUR_FORMAT)


def create_date(create_time: Column | str) -> Column:
    """Text before the first blank of ``yyyy-MM-dd HH:mm:ss``."""
    return F.get(F.split(_col(create_time), " "), F.lit(0))


def create_hour(create_time: Column | str) -> Column:
    """Text between the first blank and the following colon; null without a blank."""
    clock = F.get(F.split(_col(create_time), " "), F.lit(1))
    return F.get(F.split(clock, ":"), F.lit(0))


def mask_phone(tel: Column | str) -> Column:
    """First four characters, then seven stars."""
    return F.concat(F.substring(_col(tel), 1, PHONE_VISIBLE), F.lit(PHONE_STARS))


def age_in_years(birthday: Column | str, as_of: Column | str) -> Column:
    """Whole 365-day years from ``birthday`` to ``as_of`` (a column, or a date as text)."""
    as_of = F.lit(as_of) if isinstance(as_of, str) else as_of
    days = F.date_diff(as_of.cast("date"), _col(birthday).try_cast("date"))
    # Truncates toward zero, as integer division does.
    return F.call_function("div", days, F.lit(DAYS_PER_YEAR)).cast("int")


def previous_day(day: Column | str) -> Column:
    """The calendar day before a ``yyyy-MM-dd`` text (a column, or the text itself)."""
    day = F.lit(day) if isinstance(day, str) else day
    return F.date_format(F.date_sub(day.try_cast("date"), 1), DATE_FORMAT)


def document_id(order_id: Column | str, order_detail_id: Column | str) -> Column:
    return F.concat_ws("-", _col(order_id), _col(order_detail_id))


def log_topic(value: Column | str, prefix: str = "") -> Column:
    """A log goes to the start topic when its text contains the mark anywhere."""
    return F.when(
        _col(value).contains(STARTUP_MARK), F.lit(schemas.full_name(schemas.STARTUP, prefix))
    ).otherwise(F.lit(schemas.full_name(schemas.EVENT, prefix)))


def _last_per_name(entries: Column, name: str) -> Column:
    """Keep, in an array of structs, the last entry of each ``name`` field and drop null names."""
    entries = F.filter(entries, lambda e: e[name].isNotNull())
    names = entries[name]
    return F.filter(
        entries,
        lambda e, i: F.array_position(F.slice(names, i + 2, F.size(names)), e[name]) == 0,
    )


def _all_distinct(names: Column) -> Column:
    return (F.size(F.array_distinct(names)) == F.size(names)) & ~F.array_contains(
        F.transform(names, lambda n: n.isNull()), True
    )


def json_members(value: Column | str) -> Column:
    """Members of a JSON object given as text, values with their JSON types; null when it is none."""
    return F.from_json(_col(value), "map<string,variant>")


def stamped_json(members: Column | str, ts: Column) -> Column:
    """JSON object of the members with ``ts`` set, in place of a ``ts`` they had. A repeated name
    keeps its last value; looking for it is left to the rows that have one."""
    members = _col(members)
    stamp = ts.cast("bigint").cast("variant")
    plain = F.map_concat(
        F.map_filter(members, lambda k, v: k != "ts"), F.create_map(F.lit("ts"), stamp)
    )
    last = F.filter(_last_per_name(F.map_entries(members), "key"), lambda e: e["key"] != "ts")
    entry = F.struct(F.lit("ts").alias("key"), stamp.alias("value"))
    repaired = F.map_from_entries(F.concat(last, F.array(entry)))
    names = F.map_keys(members)
    distinct = F.size(F.array_distinct(names)) == F.size(names)
    return F.to_json(F.when(distinct, plain).when(members.isNotNull(), repaired))


def after_image_json(after: Column | str) -> Column:
    """Changed row as a flat JSON object: column name to value text, a repeated name keeps the last."""
    after = _col(after)
    plain = F.map_from_arrays(after["name"], after["value"])
    repaired = F.map_from_entries(_last_per_name(after, "name"))
    return F.to_json(F.when(_all_distinct(after["name"]), plain).otherwise(repaired))
