"""Shape results for cross-engine comparison: temporal values as fixed-format
strings and string arrays joined with ``|``, so values hash the same in every
engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, TS_FORMAT)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            c = F.array_join(c, "|")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# DuckDB counterparts used by the oracle SQL.
def sql_ts(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f')"


def sql_day(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d')"


def sql_arr(col: str) -> str:
    return f"array_to_string({col}, '|')"
