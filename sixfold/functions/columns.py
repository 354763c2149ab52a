"""Ingest coercions: slug, numbers, flags, timestamps, durations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters that count as white space where the files are written (Unicode white space and 1C-1F).
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trimmed(value: Column | str) -> Column:
    """Text without white space at its ends."""
    return F.btrim(_col(value).cast("string"), F.lit(SPACES))


def text(value: Column | str) -> Column:
    """Trimmed text; empty is NULL."""
    return F.nullif(trimmed(value), F.lit(""))


def slug(value: Column | str) -> Column:
    """Trim, runs of white space to one underscore, then drop all but ASCII letters, digits, ``_`` and ``-``."""
    return F.regexp_replace(F.regexp_replace(trimmed(value), f"[{SPACES}]+", "_"), r"[^A-Za-z0-9_\-]", "")


def session_id(year: Column | str, gp: Column | str, session: Column | str) -> Column:
    """``{year}_{gp slug}_{session slug}``."""
    return F.concat_ws("_", _col(year).cast("string"), slug(gp), slug(session))


def number(value: Column | str, kind: T.DataType | str = "double") -> Column:
    """A finite number or NULL (also for text that is no number). Decimals are rounded half up, whole numbers cut off."""
    written = _col(value).cast("string")
    kind = T._parse_datatype_string(kind) if isinstance(kind, str) else kind
    if isinstance(kind, T.DecimalType):
        return written.try_cast(kind)
    parsed = written.try_cast("double")
    # No NaN, no infinity, and none of the type suffixes (1d, 1f) that the cast lets through.
    is_number = (F.abs(parsed) < float("inf")) & ~F.lower(F.right(F.rtrim(written), F.lit(1))).isin("d", "f")
    return F.when(is_number, parsed).try_cast(kind)


def whole(value: Column | str) -> Column:
    """Whole number, decimals cut off (``'12.9'`` is 12); anything else is NULL."""
    return number(value, "int")


def flag(value: Column | str) -> Column:
    """1 for true, 0 for false and for NULL."""
    return F.coalesce(_col(value).try_cast("boolean"), F.lit(False)).cast("int")


def iso_timestamp(value: Column | str) -> Column:
    """ISO date-time, with or without zone (``Z`` accepted), as its written wall clock; bad text is NULL."""
    # The zone is kept out of the value: the target column has no zone.
    bare = F.regexp_replace(F.trim(_col(value).cast("string")), r"(?i)(z|[+-]\d{2}:?\d{2})$", "")
    shaped = F.when(bare.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$"), bare)
    return shaped.try_cast("timestamp_ntz")


def durations_to_seconds(df: DataFrame) -> DataFrame:
    """Every day-time interval column as seconds."""
    columns = {f.name: F.col(f.name).cast("decimal(20,6)").cast("double") for f in df.schema if isinstance(f.dataType, T.DayTimeIntervalType)}
    return df.withColumns(columns) if columns else df


def truncated(value: Column | str) -> Column:
    """Cut towards zero (not floor)."""
    return _col(value).cast("bigint")


def stddev_or_zero(value: Column | str) -> Column:
    """Sample standard deviation; 0 for a single value."""
    value = _col(value)
    return F.when(F.count(value) == 1, F.lit(0.0)).otherwise(F.stddev_samp(value))
