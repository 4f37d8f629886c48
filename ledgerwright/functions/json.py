"""JSON text <-> typed columns. Documents are parsed once with an explicit schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One timestamp layout for every JSON document written or read here.
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}


def to_text(value: Column) -> Column:
    return F.to_json(value, JSON_OPTIONS)


def parse(text: Column, schema: T.DataType) -> Column:
    return F.from_json(text, schema, JSON_OPTIONS)


def parse_fields(df: DataFrame, text_column: str, schema: T.StructType, *keep: str) -> DataFrame:
    """``keep`` columns plus every field of ``schema`` parsed from ``text_column``.

    The parsed row is produced by a generator (``inline`` of a one-element
    array). Filters on parsed fields then stay above it instead of being pushed
    below with the parse inlined, so each document is parsed once, not once
    per filter and once per projection.
    """
    return df.select(*keep, F.inline(F.array(parse(F.col(text_column), schema))))


def path_text(text: Column, path: str) -> Column:
    """``text #>> '{path}'``: one JSON path as text, NULL when absent."""
    return F.get_json_object(text, path)


MONEY_T = T.DecimalType(14, 2)

COURIER = T.StructType([T.StructField("_id", T.StringType()), T.StructField("name", T.StringType())])

DELIVERY = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("order_ts", T.TimestampNTZType()),
    T.StructField("delivery_id", T.StringType()), T.StructField("courier_id", T.StringType()),
    T.StructField("address", T.StringType()), T.StructField("delivery_ts", T.TimestampNTZType()),
    T.StructField("rate", T.IntegerType()), T.StructField("sum", MONEY_T),
    T.StructField("tip_sum", MONEY_T)])

MENU_ITEM = T.StructType([T.StructField("_id", T.StringType()), T.StructField("name", T.StringType()),
                          T.StructField("price", MONEY_T)])
RESTAURANT = T.StructType([T.StructField("_id", T.StringType()), T.StructField("name", T.StringType()),
                           T.StructField("menu", T.ArrayType(MENU_ITEM))])

USER = T.StructType([T.StructField("_id", T.StringType()), T.StructField("name", T.StringType()),
                     T.StructField("login", T.StringType())])

ORDER_ITEM = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType()),
                           T.StructField("price", MONEY_T), T.StructField("quantity", T.IntegerType())])
STATUS = T.StructType([T.StructField("status", T.StringType()),
                       T.StructField("dttm", T.TimestampNTZType())])
ORDER = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("restaurant", T.StructType([T.StructField("id", T.StringType())])),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("user", T.StructType([T.StructField("id", T.StringType())])),
    T.StructField("order_items", T.ArrayType(ORDER_ITEM)),
    T.StructField("bonus_payment", MONEY_T),
    T.StructField("statuses", T.ArrayType(STATUS)),
    T.StructField("final_status", T.StringType())])

# Narrow views of the same documents: the parser skips every field not named,
# so loaders that need only scalar fields never materialise the arrays.
ORDER_HEADER = T.StructType([f for f in ORDER.fields if f.name in ("restaurant", "date", "user", "final_status")])
RESTAURANT_HEADER = T.StructType([f for f in RESTAURANT.fields if f.name == "name"])

PAYMENT = T.StructType([
    T.StructField("product_id", T.StringType()), T.StructField("product_name", T.StringType()),
    T.StructField("price", MONEY_T), T.StructField("quantity", T.IntegerType()),
    T.StructField("product_cost", MONEY_T), T.StructField("bonus_payment", MONEY_T),
    T.StructField("bonus_grant", MONEY_T)])
BONUS_EVENT = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("order_id", T.StringType()),
    T.StructField("order_date", T.StringType()),
    T.StructField("product_payments", T.ArrayType(PAYMENT))])

def as_text(schema: T.DataType) -> T.DataType:
    """``schema`` with every scalar read as text, so that no value is lost before it is checked."""
    if isinstance(schema, T.StructType):
        return T.StructType([T.StructField(f.name, as_text(f.dataType)) for f in schema.fields])
    return T.ArrayType(as_text(schema.elementType)) if isinstance(schema, T.ArrayType) else T.StringType()


ORDER_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"
