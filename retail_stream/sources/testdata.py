"""Records and messages derived from the given tables; wall-clock times there are UTC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_stream import schemas
from retail_stream.functions import records

AS_OF = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, in the splits its files give."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "props",
        ms.alias("ts_ms"),
        F.col("ts").cast("timestamp").alias("arrival_ts"),
    )


def _device_columns(mid) -> dict:
    ios = F.col("user_id") % 10 < 3
    return {
        "mid": mid,
        "uid": F.col("user_id").cast("string"),
        "appid": F.lit("app"),
        "area": F.concat(F.lit("area_"), (F.col("user_id") % 10).cast("string")),
        "os": F.when(ios, F.lit("ios")).otherwise(F.lit("andriod")),
    }


def _startup_columns() -> dict:
    ios = F.col("user_id") % 10 < 3
    other = F.concat(F.lit("ch_"), (F.col("user_id") % 7).cast("string"))
    return {
        **_device_columns(F.concat(F.lit("mid_"), F.col("user_id").cast("string"))),
        "ch": F.when(ios, F.lit("appstore")).otherwise(other),
        "type": F.lit("startup"),
        "vs": F.concat(F.lit("1."), (F.col("user_id") % 3).cast("string")),
    }


def _event_columns() -> dict:
    kind = F.col("event_type")
    page = F.col("event_id") % 50 + 1
    return {
        **_device_columns((F.col("user_id") % 10).cast("string")),
        "type": F.lit("event"),
        "evid": F.when(kind == "purchase", F.lit("coupon"))
        .when(kind == "click", F.lit("clickItem"))
        .otherwise(kind),
        "pgid": page,
        "npgid": page,
        "itemid": F.get_json_object("props", "$.k").cast("int"),
    }


def _select(df: DataFrame, columns: dict, *more) -> DataFrame:
    return df.select(*[c.alias(n) for n, c in columns.items()], *more)


def startup_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start records without date and hour."""
    signups = _events(spark, sf_dir).filter(F.col("event_type") == "signup")
    return _select(signups, _startup_columns(), F.col("ts_ms").alias("ts"), "arrival_ts")


def startup_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = records.with_log_time(startup_payload(spark, sf_dir))
    return logs.select(*schemas.STARTUP_COLUMNS)


def event_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(
        _events(spark, sf_dir), _event_columns(), F.col("ts_ms").alias("ts"), "arrival_ts"
    )


def event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records with their event time."""
    numbers = {n: F.col(n).cast("string") for n in ("pgid", "npgid", "itemid")}
    logs = event_payload(spark, sf_dir).withColumns(numbers)
    return logs.withColumn("event_time", F.timestamp_millis("ts"))


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs as devices send them: signups as starts, all else as events, with a clock of their own."""
    events = _events(spark, sf_dir)
    own_clock = F.lit(1).alias("ts")
    start = F.struct(*[c.alias(n) for n, c in _startup_columns().items()], own_clock)
    event = F.struct(*[c.alias(n) for n, c in _event_columns().items()], own_clock)
    value = F.when(F.col("event_type") == "signup", F.to_json(start)).otherwise(F.to_json(event))
    return events.select(value.alias("value"), "arrival_ts", "event_id", "event_type")


def damaged_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event messages of which error events lost their end and views lost their device."""
    payload = _select(
        _events(spark, sf_dir), _event_columns(), F.col("ts_ms").alias("ts"), "arrival_ts", "event_type"
    )
    mid = F.when(F.col("event_type") != "view", F.col("mid"))
    fields = [mid.alias("mid") if f == "mid" else F.col(f) for f in schemas.EVENT.fields if f != "ch"]
    whole = payload.select(F.to_json(F.struct(*fields)).alias("text"), "event_type", "arrival_ts")
    cut = F.expr("substring(text, 1, length(text) - 1)")
    value = F.when(F.col("event_type") == "error", cut).otherwise(F.col("text"))
    return whole.select(value.alias("value"), "arrival_ts")


def _order_time():
    return F.expr("o_orderdate + make_dt_interval(0, 0, 0, o_orderkey * 7919 % 86400)")


def order_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    text = lambda c: F.col(c).cast("string")
    known = {
        "id": text("o_orderkey"),
        "province_id": text("c_nationkey"),
        "consignee": F.col("c_name"),
        "consignee_tel": F.concat(F.lit("138"), F.lpad(text("o_custkey"), 8, "0")),
        "order_status": F.col("o_orderstatus"),
        "payment_way": F.col("o_orderpriority"),
        "user_id": text("o_custkey"),
        "total_amount": F.col("o_totalprice"),
        "create_time": F.date_format(_order_time(), "yyyy-MM-dd HH:mm:ss"),
    }
    none = F.lit(None).cast("string")
    return joined.select(
        *[known.get(n, none).alias(n) for n in schemas.ORDER.fields],
        _order_time().cast("timestamp").alias("arrival_ts"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order records with date and hour, phone not yet masked."""
    return records.with_create_time(order_payload(spark, sf_dir))


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    owners = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    joined = lines.join(owners, lines.l_orderkey == owners.o_orderkey).join(
        part, lines.l_partkey == part.p_partkey
    )
    later = F.expr(
        "make_dt_interval(0, 0, 0, (l_partkey * 7 + l_linenumber * 131) % 1201 - 600)"
    )
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    none = F.lit(None).cast("string")
    return joined.select(
        F.concat_ws(
            "-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
            cents.cast("string"),
        ).alias("id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("p_name").alias("sku_name"),
        F.col("l_partkey").cast("string").alias("sku_id"),
        F.col("p_retailprice").cast("string").alias("order_price"),
        none.alias("img_url"),
        F.col("l_quantity").cast("string").alias("sku_num"),
        (_order_time() + later).cast("timestamp").alias("arrival_ts"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User records; a tenth of the customers is unknown, a third of the rest has an older version."""
    customer = table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 10 != 0)
    version = F.explode(
        F.when(F.col("c_custkey") % 3 == 0, F.array(F.lit("old"), F.lit("new"))).otherwise(
            F.array(F.lit("new"))
        )
    )
    rows = customer.select("*", version.alias("version"))
    old = F.col("version") == "old"
    return rows.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("login_name"),
        F.when(old, F.lit("OLD")).otherwise(F.col("c_mktsegment")).alias("user_level"),
        F.date_format(
            F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") * 37 % 20000).cast("int")),
            "yyyy-MM-dd",
        ).alias("birthday"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.when(old, F.lit("2020-01-01").cast("timestamp"))
        .otherwise(F.lit("2020-01-02").cast("timestamp"))
        .alias("arrival_ts"),
    )


def _after(names):
    entry = lambda n: F.struct(F.lit(n).alias("name"), F.col(n).cast("string").alias("value"))
    return F.array(F.struct(F.array(*[entry(n) for n in names]).alias("after")))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change envelopes: orders in three event types and some transaction marks, lines and users as
    inserts and updates, and a table nobody forwards."""
    order_rows = order_payload(spark, sf_dir)
    key = F.col("id").cast("bigint")
    order_fields = [
        "id", "province_id", "consignee", "consignee_tel", "order_status", "payment_way", "user_id",
        "total_amount", "create_time",
    ]

    def envelope(df, entry, name, event, fields):
        return df.select(
            entry.alias("entry_type"),
            F.lit("shop").alias("schema_name"),
            F.lit(name).alias("table_name"),
            event.alias("event_type"),
            _after(fields).alias("rows"),
            "arrival_ts",
        )

    row = F.lit("ROWDATA")
    order_event = (
        F.when(key % 5 == 0, F.lit("UPDATE")).when(key % 5 == 1, F.lit("DELETE")).otherwise(F.lit("INSERT"))
    )
    mark = F.when(key % 11 == 0, F.lit("TRANSACTIONBEGIN")).otherwise(row)
    user_event = F.when(F.col("user_level") == "OLD", F.lit("INSERT")).otherwise(F.lit("UPDATE"))
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.lit("2020-01-01").cast("timestamp").alias("arrival_ts"),
    )
    parts = [
        envelope(order_rows, mark, "order_info", order_event, order_fields),
        envelope(
            details(spark, sf_dir), row, "order_detail", F.lit("INSERT"),
            ["id", "order_id", "sku_name", "sku_id", "order_price", "sku_num"],
        ),
        envelope(users(spark, sf_dir), row, "user_info", user_event, list(schemas.USER.fields)),
        envelope(nation, row, "base_province", F.lit("UPDATE"), ["id"]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
