"""JSON text to typed records, one parse per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def parse_json(df: DataFrame, schema: T.StructType | str, value: str = "value") -> DataFrame:
    """Replace `value` by the fields of its JSON object plus `_corrupt` (the text, if unreadable).

    The record goes through a one-element generator. A plain projection would be merged with the
    filters above it and the text parsed once for the filter and again for the output.
    """
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    full = T.StructType(fields.fields + [T.StructField(CORRUPT, T.StringType())])
    record = F.from_json(F.col(value), full, {"columnNameOfCorruptRecord": CORRUPT})
    others = [c for c in df.columns if c != value]
    return df.select(*others, F.inline_outer(F.array(record)))


def joined_key(time_text: Column, device: Column) -> Column:
    """`time_device`, with the text null for a device that has no id."""
    return F.concat(time_text, F.lit("_"), F.coalesce(device, F.lit("null")))
