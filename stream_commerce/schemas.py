"""Record types carried by the topics and tables.

Every JSON field is read as STRING: row changes quote all their values, and a numeric type in
`from_json` turns a quoted number into null. Casts happen where a number is needed.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Topic names and the key prefixes a migrating user already has.
BASE_LOG_TOPIC = "base_log"
START_TOPIC = "REALTIME_STARTUP_LOG"
ACTION_TOPIC = "REALTIME_ACTION_LOG"
ORDER_INFO_TOPIC = "REALTIME_DB_ORDER_INFO"
ORDER_DETAIL_TOPIC = "REALTIME_DB_ORDER_DETAIL"

# Column lists of the records, in the order they are stored.
START_LOG_SOURCE = _strings(
    "open_ad_ms", "os", "ch", "is_new", "mid", "open_ad_id", "vc", "ar", "uid", "entry",
    "open_ad_skip_ms", "md", "loading_time", "ba", "ts",
)
START_LOG_COLUMNS = [
    "id", "open_ad_ms", "os", "ch", "is_new", "mid", "open_ad_id", "vc", "ar", "uid", "entry",
    "open_ad_skip_ms", "md", "loading_time", "ba", "ts", "start_date", "start_time",
]
ACTION_LOG = _strings(
    "os", "ch", "is_new", "last_page_id", "mid", "source_type", "vc", "ar", "uid", "page_id",
    "during_time", "md", "ba", "ts", "item", "item_type", "action_id",
)
ORDER_INFO = _strings(
    "id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status",
    "payment_way", "user_id", "img_url", "total_amount", "expire_time", "delivery_address",
    "create_time", "operate_time", "tracking_no", "parent_order_id", "out_trade_no", "trade_body",
)
ORDER_DETAIL = _strings(
    "id", "order_id", "sku_name", "sku_id", "order_price", "img_url", "sku_num",
)
USER_INFO = _strings("id", "login_name", "user_level", "birthday", "gender")
PROVINCE_INFO = _strings("id", "name", "region_id", "area_code", "iso_code", "iso_3166_2")
SALE_DETAIL_COLUMNS = [
    "order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id",
    "user_gender", "user_age", "user_level", "sku_price", "sku_name", "sku_num", "dt",
    "province_id", "province_name", "region_id", "iso_code", "iso_3166_2",
]

# One database row change: a statement on one table with the after-image of each row it touched.
ROW_CHANGE = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("ts", T.LongType()),
    T.StructField("rows", T.ArrayType(T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("value", T.StringType()),
    ])))),
])

MONEY = T.DecimalType(16, 2)
