"""Column cleaning: each function returns a Column (JVM-side, codegen-friendly)
and has a ``with_*`` DataFrame form for ``DataFrame.transform``.

Behaviour notes (Spark 4 runs with ANSI on, so ``try_*`` variants keep the
"bad input gives NULL" semantics of the original ANSI-off pipeline):

* digits: every non-digit goes, sign and decimal point included ('2.5' -> 25).
* currency: only '$' and ',' go; '(5.00)' or 'USD 5' stay unparseable -> NULL.
* timestamps: only offsets parse; zone names are first rewritten to offsets.
* corrupt flag: a row is dropped only when the flag equals 'Y' (case-sensitive).
* change hash: ``concat_ws`` skips NULLs, so ('a', NULL, 'b') and ('a', 'b', NULL)
  hash alike; pass ``null_token`` to make NULL positions count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Zone abbreviations rewritten to UTC offsets before parsing,
# applied in this order.
ZONE_OFFSETS: Mapping[str, str] = {
    "PST": "-08:00",
    "PDT": "-07:00",
    "EST": "-05:00",
    "EDT": "-04:00",
}
# Fixed value: the parse pattern of zoned order timestamps.
ZONED_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss XXX"
# Fixed value: the separator of the change-hash input.
HASH_SEPARATOR = "|"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def title_case(col: str | Column) -> Column:
    """Lower-case, then upper-case the first letter after each space."""
    return F.initcap(_c(col))


def digits_only(col: str | Column) -> Column:
    return F.regexp_replace(_c(col), "[^0-9]", "")


def strip_currency(col: str | Column) -> Column:
    """Delete every '$' and ','.  (``translate`` deletes characters that have
    no counterpart; same result as the regex class ``[$,]``, without a regex.)"""
    return F.translate(_c(col), "$,", "")


def zone_names_to_offsets(col: str | Column,
                          zones: Mapping[str, str] = ZONE_OFFSETS) -> Column:
    """Replace each zone name, wherever it occurs, by its offset (literal
    replacement: the names hold no regex metacharacters)."""
    out = _c(col)
    for name, offset in zones.items():
        out = F.replace(out, F.lit(name), F.lit(offset))
    return out


def parse_zoned_timestamp(col: str | Column, zones: Mapping[str, str] = ZONE_OFFSETS,
                          fmt: str = ZONED_TIMESTAMP_FORMAT) -> Column:
    """Trim (spaces only), rewrite zone names, parse to an instant; NULL when bad."""
    return F.try_to_timestamp(zone_names_to_offsets(F.trim(_c(col)), zones), F.lit(fmt))


def to_int(col: str | Column) -> Column:
    return _c(col).try_cast("int")


def to_money(col: str | Column, precision: int = 10, scale: int = 2) -> Column:
    return _c(col).try_cast(f"decimal({precision},{scale})")


def is_not_corrupt(flag: str | Column, marker: str = "Y") -> Column:
    """True unless the flag equals ``marker``; NULL flags count as clean."""
    return ~_c(flag).eqNullSafe(F.lit(marker))


def change_hash(cols: Sequence[str | Column], null_token: str | None = None,
                sep: str = HASH_SEPARATOR) -> Column:
    """sha2-256 hex of the separator-joined values."""
    parts = [_c(c) if null_token is None else F.coalesce(_c(c).cast("string"), F.lit(null_token))
             for c in cols]
    return F.sha2(F.concat_ws(sep, *parts), 256)


# DataFrame forms (for DataFrame.transform) ----------------------------------

def with_title_case(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, title_case(column))


def with_digits(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, digits_only(column))


def with_currency(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, strip_currency(column))


def with_clean_timestamp(df: DataFrame, column: str, out: str | None = None,
                         zones: Mapping[str, str] = ZONE_OFFSETS) -> DataFrame:
    return df.withColumn(out or column, parse_zoned_timestamp(column, zones))


def drop_corrupt(df: DataFrame, flag_column: str, marker: str = "Y") -> DataFrame:
    return df.filter(is_not_corrupt(flag_column, marker))


def with_change_hash(df: DataFrame, columns: Sequence[str], out: str = "hash_value",
                     null_token: str | None = None) -> DataFrame:
    return df.withColumn(out, change_hash(columns, null_token))
