"""Column-level cleaning: date parse, typed null fill, name folding, audits.

All of these are single projections or one aggregate; none loops over rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The start-date text format and the per-type fill defaults.
MDY = "M/d/yyyy"
FILL_STRING = "Unknown"
FILL_NUMBER = 0


def parse_mdy(col: str | Column, fmt: str = MDY) -> Column:
    """Text -> date; text that does not parse becomes null instead of failing."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_date(c, fmt)


def parse_dates(df: DataFrame, cols: list[str], fmt: str = MDY,
                keep_raw: bool = False) -> DataFrame:
    """Replace each text column by its parsed date, in place (same position).

    With ``keep_raw`` the text is also kept as ``<col>_raw`` so that rejects
    (text present, date null) can be counted by the quality report.
    """
    out = df
    if keep_raw:
        out = out.withColumns({f"{c}_raw": F.col(c) for c in cols})
    return out.withColumns({c: parse_mdy(c, fmt) for c in cols})


def fill_value(dtype: T.DataType):
    """Default for a null of this type, or None when the type is left alone.

    string -> 'Unknown'; integral, floating and decimal -> 0. Dates, booleans
    and timestamps stay null. Decimal is included because our schema reads the
    measures as decimal where inference would have given double.
    """
    if isinstance(dtype, T.StringType):
        return FILL_STRING
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return FILL_NUMBER
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return float(FILL_NUMBER)
    if isinstance(dtype, T.DecimalType):
        return FILL_NUMBER
    return None


def fill_nulls_by_type(df: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """One projection that fills every column by its type (see ``fill_value``),
    except the columns in ``exclude``."""
    fills = {}
    skip = set(exclude or [])
    for field in df.schema.fields:
        if field.name in skip:
            continue
        v = fill_value(field.dataType)
        if v is not None:
            fills[field.name] = F.coalesce(F.col(field.name), F.lit(v).cast(field.dataType))
    return df.withColumns(fills) if fills else df


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Fold all column names to lower case (as the warehouse folds identifiers)."""
    return df.toDF(*[c.lower() for c in df.columns])


def null_audit(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Null count of every column in ONE scan: (ordinal, column_name, null_count)."""
    cols = cols or df.columns
    wide = df.agg(*[
        F.struct(F.lit(i + 1).alias("ordinal"), F.lit(c).alias("column_name"),
                 F.count_if(F.col(c).isNull()).alias("null_count")).alias(f"_{i}")
        for i, c in enumerate(cols)
    ])
    # array of structs -> rows: a tiny one-row explode, no second scan
    return wide.select(F.explode(F.array(*[f"_{i}" for i in range(len(cols))])).alias("a")) \
        .select("a.ordinal", "a.column_name", "a.null_count")


def filter_is_null(df: DataFrame, col: str) -> DataFrame:
    """Rows whose column is null (pushed to the scan as an IsNull filter)."""
    return df.where(F.col(col).isNull())


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column: ordinal, name, Spark type name, non-null count.

    The type part comes from the schema; the count part is one aggregate.
    """
    fields = df.schema.fields
    wide = df.agg(*[
        F.struct(F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.count(F.col(f.name)).alias("non_null_count")).alias(f"_{i}")
        for i, f in enumerate(fields)
    ])
    return wide.select(F.explode(F.array(*[f"_{i}" for i in range(len(fields))])).alias("a")) \
        .select("a.ordinal", "a.column_name", "a.data_type", "a.non_null_count")


def preview(df: DataFrame, n: int = 20, order: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows in a stated order (repeatable, unlike ``show``'s
    first rows). Planned as a per-task top-n plus one merge, not a full sort."""
    return df.orderBy(*(order or df.columns[:1])).limit(n)
