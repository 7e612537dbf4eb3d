"""Record layouts and the topic registry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: column names and types of the records -------------------------------------

STARTUP_PAYLOAD = (
    ("mid", "string"),
    ("uid", "string"),
    ("appid", "string"),
    ("area", "string"),
    ("os", "string"),
    ("ch", "string"),
    ("type", "string"),
    ("vs", "string"),
    ("ts", "bigint"),
)

EVENT_PAYLOAD = (
    ("mid", "string"),
    ("uid", "string"),
    ("appid", "string"),
    ("area", "string"),
    ("os", "string"),
    ("ch", "string"),
    ("type", "string"),
    ("evid", "string"),
    ("pgid", "string"),
    ("npgid", "string"),
    ("itemid", "string"),
    ("ts", "bigint"),
)

ORDER_PAYLOAD = (
    ("id", "string"),
    ("province_id", "string"),
    ("consignee", "string"),
    ("order_comment", "string"),
    ("consignee_tel", "string"),
    ("order_status", "string"),
    ("payment_way", "string"),
    ("user_id", "string"),
    ("img_url", "string"),
    ("total_amount", "double"),
    ("expire_time", "string"),
    ("delivery_address", "string"),
    ("create_time", "string"),
    ("operate_time", "string"),
    ("tracking_no", "string"),
    ("parent_order_id", "string"),
    ("out_trade_no", "string"),
    ("trade_body", "string"),
)

DETAIL_PAYLOAD = (
    ("id", "string"),
    ("order_id", "string"),
    ("sku_name", "string"),
    ("sku_id", "string"),
    ("order_price", "string"),
    ("img_url", "string"),
    ("sku_num", "string"),
)

USER_PAYLOAD = (
    ("id", "string"),
    ("login_name", "string"),
    ("user_level", "string"),
    ("birthday", "string"),
    ("gender", "string"),
)

STARTUP_COLUMNS = (
    "mid", "uid", "appid", "area", "os", "ch", "type", "vs", "log_date", "log_hour", "ts",
)
EVENT_COLUMNS = (
    "mid", "uid", "appid", "area", "os", "ch", "type", "evid", "pgid", "npgid", "itemid",
    "log_date", "log_hour", "ts",
)
ORDER_COLUMNS = tuple(name for name, _ in ORDER_PAYLOAD) + ("create_date", "create_hour")
DETAIL_COLUMNS = tuple(name for name, _ in DETAIL_PAYLOAD)
USER_COLUMNS = tuple(name for name, _ in USER_PAYLOAD)
SALE_COLUMNS = (
    "order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id",
    "user_gender", "user_age", "user_level", "sku_price", "sku_name", "dt",
)
ALERT_COLUMNS = ("mid", "uids", "itemIds", "events", "ts")

# --- end of fixed values ---------------------------------------------------------------------


_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def struct(columns: tuple[tuple[str, str], ...]) -> T.StructType:
    """Schema from (name, type) pairs; needs no session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


@dataclass(frozen=True)
class Topic:
    """One message topic: its name, its JSON payload, and the fields a row cannot do without."""

    name: str
    payload: tuple[tuple[str, str], ...]
    required: tuple[str, ...]

    @property
    def fields(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.payload)

    @property
    def schema(self) -> T.StructType:
        """Typed payload schema."""
        return struct(self.payload)


STARTUP = Topic("start", STARTUP_PAYLOAD, ("mid", "ts"))
EVENT = Topic("event", EVENT_PAYLOAD, ("mid", "ts"))
ORDER = Topic("order_info", ORDER_PAYLOAD, ("id",))
DETAIL = Topic("order_detail", DETAIL_PAYLOAD, ("id", "order_id"))
USER = Topic("user_info", USER_PAYLOAD, ("id",))

TOPICS: dict[str, Topic] = {t.name: t for t in (STARTUP, EVENT, ORDER, DETAIL, USER)}

_CELL = struct((("name", "string"), ("value", "string")))
_CHANGED_ROW = T.StructType([T.StructField("after", T.ArrayType(_CELL))])
# Fixed value: the entry type of a changed row.
ROW_ENTRY = "ROWDATA"

CHANGE_ENVELOPE = T.StructType(
    [
        T.StructField("entry_type", T.StringType()),
        T.StructField("schema_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("rows", T.ArrayType(_CHANGED_ROW)),
    ]
)


def full_name(topic: Topic | str, prefix: str = "") -> str:
    """Name of a topic on the message bus: a deployment's prefix plus the registry name."""
    name = topic.name if isinstance(topic, Topic) else TOPICS[topic].name
    return prefix + name
