"""Any sort order as an ascending one: keys that compare like the wanted order.

Slices, ranges and cut points compare rows by ascending columns. For a descending column its values are turned round:
integers bit by bit (so the smallest one has a counterpart), decimals and floats by their sign, texts byte by byte with a
mark behind the last one, so that a prefix comes after what it begins. NULLs are placed as Spark places them:
first when ascending, last when descending; NaN is the largest number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEX, TURNED = "0123456789ABCDEF", "FEDCBA9876543210"
#: Behind the last byte; larger than any turned digit.
END = "~"


def turned(c: Column, kind: T.DataType) -> list[Column]:
    """Columns whose ascending order is the descending order of ``c`` without its NULLs."""
    if isinstance(kind, T.IntegralType):
        return [F.bitwise_not(c)]
    if isinstance(kind, T.BooleanType):
        return [~c]
    if isinstance(kind, T.DateType):
        return [-F.unix_date(c)]
    if isinstance(kind, T.TimestampType):
        return [F.bitwise_not(F.unix_micros(c))]
    if isinstance(kind, T.TimestampNTZType):
        return [F.bitwise_not(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c))]
    if isinstance(kind, T.DecimalType):
        return [-c]
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return [~F.isnan(c), F.when(~F.isnan(c), -c)]
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return [F.concat(F.translate(F.hex(c.cast("binary")), HEX, TURNED), F.lit(END))]
    raise TypeError(f"no descending key for {kind.simpleString()}")


def ascending(df: DataFrame, order: Sequence[str], prefix: str = "_order") -> dict[str, Column]:
    """Named key columns whose ascending order is ``order``, where a leading ``-`` means descending."""
    keys: list[Column] = []
    for name in order:
        column = F.col(name.removeprefix("-"))
        if name.startswith("-"):
            keys += [column.isNull(), *turned(column, df.schema[name[1:]].dataType)]
        else:
            keys.append(column)
    return {f"{prefix}{i}": key for i, key in enumerate(keys)}
