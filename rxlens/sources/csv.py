"""Read the five extracts as CSV text with their raw headers.

Columns are located by header name (the exports' column order is not
relied on), read as text, renamed to clean names and typed in one
projection.  Empty text is null; dates are parsed with the extract formats.
A missing header, or a number or flag that cannot be read, is an error.

Quotes inside a field are doubled, by the writer as by the readers, and a
backslash is an ordinary character.  A file is read in splits unless a field
holds a line break: every such field leaves a physical line with an odd number
of quotes, which one parallel pass over the lines finds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlens.functions.dates import (format_long_date, format_short_date, parse_long_date,
                                    parse_short_date)
from rxlens.sources import schemas as S


def _strict(name: str, kind: str) -> Column:
    """The column as ``kind``; a value that does not read as one fails the job."""
    text = F.col(f"`{name}`")
    typed = text.try_cast(kind)
    bad = F.raise_error(F.concat(F.lit(f"column {name}: not a {kind}: "), text))
    return F.when(text.isNotNull() & typed.isNull(), bad.cast(kind)).otherwise(typed)


# one quoting rule for every CSV that is read or written
CSV_RULES = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
             "ignoreTrailingWhiteSpace": False}


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Does a quoted field of the file(s) go over more than one line?"""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def _read(spark: SparkSession, path: str, rename: dict[str, str], types: dict[str, str],
          long_dates=(), short_dates=(), multi_line: bool | None = None) -> DataFrame:
    if multi_line is None:
        multi_line = has_line_breaks(spark, path)
    raw = spark.read.options(**CSV_RULES).option("multiLine", multi_line).csv(path)
    missing = [k for k, v in rename.items() if k not in raw.columns and v not in S.UNUSED]
    if missing:
        raise ValueError(f"{path}: missing header(s) {missing}")
    df = raw.withColumnsRenamed({k: v for k, v in rename.items() if k in raw.columns})
    exprs = {}
    for c in df.columns:
        if c in long_dates:
            exprs[c] = parse_long_date(c)
        elif c in short_dates:
            exprs[c] = parse_short_date(c)
        elif c in types:
            exprs[c] = _strict(c, types[c])
    return df.withColumns(exprs) if exprs else df


def read_users(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """``ID_data.csv``."""
    return _read(spark, path, S.USERS_RENAME, S.USERS_TYPES, multi_line=multi_line)


def read_dispensations(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """``dispensations_data.csv``."""
    return _read(spark, path, S.DISPENSATIONS_RENAME, S.DISPENSATIONS_TYPES,
                 S.DISPENSATIONS_LONG_DATES, multi_line=multi_line)


def read_searches(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """S3: ``searches_data.csv``."""
    return _read(spark, path, S.SEARCHES_RENAME, S.SEARCHES_TYPES, S.SEARCHES_LONG_DATES, multi_line=multi_line)


def read_active_rx(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """``active_rx_data.csv``."""
    return _read(spark, path, S.ACTIVE_RX_RENAME, {}, S.ACTIVE_RX_LONG_DATES, multi_line=multi_line)


def read_naive_rx(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """``naive_rx_data.csv``."""
    return _read(spark, path, S.NAIVE_RX_RENAME, {}, S.NAIVE_RX_LONG_DATES, S.NAIVE_RX_SHORT_DATES,
                 multi_line=multi_line)


def to_raw_layout(df: DataFrame, rename: dict[str, str], long_dates=(), short_dates=()) -> DataFrame:
    """Inverse of a reader: clean names/types back to raw headers and text."""
    back = {v: k for k, v in rename.items()}
    exprs = []
    for c in df.columns:
        if c in long_dates:
            e = format_long_date(c)
        elif c in short_dates:
            e = format_short_date(c)
        else:
            e = F.col(f"`{c}`").cast("string")
        exprs.append(e.alias(back.get(c, c)))
    return df.select(*exprs)


def write_extract_csv(df: DataFrame, path: str, rename: dict[str, str], long_dates=(),
                      short_dates=()) -> None:
    """K3: land an extract as header CSV text in the raw layout."""
    (to_raw_layout(df, rename, long_dates, short_dates)
     .write.mode("overwrite").options(**CSV_RULES).csv(path))
