"""Broadcasts of tables whose size was measured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: bytes up to which a table is broadcast
BROADCAST_BYTES = 64 << 20
#: bytes a row costs beside its values
_ROW = 32


def _bytes_of(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 8
    if isinstance(kind, T.BinaryType):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 8
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + 8
    return F.lit(16)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows, in one aggregate with a partial sum in every task."""
    row = F.lit(_ROW)
    for field in df.schema.fields:
        row = row + _bytes_of(F.col(f"`{field.name}`"), field.dataType)
    return int(df.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0))).first()[0])


def small_side(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a table for broadcast if its measured size allows; else it is joined by shuffle."""
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df
