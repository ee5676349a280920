"""Scalar helpers: each takes and returns ``Column`` objects, so all stay in codegen."""

from __future__ import annotations

import datetime
import os
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = T.DecimalType(18, 3)
MONEY = T.DecimalType(18, 2)
EXACT = T.DecimalType(28, 9)  # for sums of measures that are no money
NTZ = T.TimestampNTZType()

# Fixed value: text that stands for a missing key part in a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- time ----------------------------------------------------------------
def instant(c: Column | str) -> Column:
    """Zone-free timestamp to an instant (session zone), as watermarks need."""
    return col(c).cast("timestamp")


def trunc_ts(unit: str, c: Column | str) -> Column:
    """``date_trunc`` that keeps the zone-free type."""
    return F.date_trunc(unit, col(c)).cast(NTZ)


def epoch_seconds(c: Column | str) -> Column:
    return instant(c).cast("long")


def second_diff(start: Column | str, end: Column | str) -> Column:
    """Whole-second boundaries crossed from start to end."""
    return epoch_seconds(end) - epoch_seconds(start)


def minute_diff(start: Column | str, end: Column | str) -> Column:
    """Minute boundaries crossed (00:00:59 to 00:01:01 is one)."""
    minute = lambda c: F.floor(epoch_seconds(c) / 60)
    return (minute(end) - minute(start)).cast("long")


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    return second_diff(start, end) / F.lit(60.0)


def duration_hours(start: Column | str, end: Column | str) -> Column:
    return second_diff(start, end) / F.lit(3600.0)


def quarter_label(c: Column | str) -> Column:
    return F.concat(F.year(col(c)).cast("string"), F.lit("/Q"), F.quarter(col(c)).cast("string"))


def days_back(given: int | None = None, variable: str = "DAYS_BACK", default: int = 30) -> int:
    """A given value wins over the environment, the environment over the default."""
    return given if given is not None else int(os.environ.get(variable, default))


def in_last_days(c: Column | str, days: int, today: datetime.date | None = None) -> Column:
    """At or after midnight ``days`` before ``today`` (the current date if not given)."""
    end = F.lit(today) if today else F.current_date()
    return col(c) >= F.date_sub(end, days).cast(NTZ)


def parse_ts(c: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text to timestamp; malformed text gives NULL."""
    return F.try_to_timestamp(col(c), F.lit(pattern))


def from_millis(c: Column | str) -> Column:
    return F.timestamp_millis(col(c).cast("long"))


def ts_text(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd HH:mm:ss")


# ---- keys ----------------------------------------------------------------
def _texts(cols: Iterable[Column | str], missing: str) -> list[Column]:
    return [F.coalesce(col(c).cast("string"), F.lit(missing)) for c in cols]


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the ``-`` joined texts, a marker for missing parts."""
    return F.md5(F.concat_ws("-", *_texts(cols, NULL_KEY_PART)))


def row_hash(*cols: Column | str) -> Column:
    """Hex md5 of the parts glued without a separator (landing-table form)."""
    return F.md5(F.concat(*_texts(cols, "")))


def row_hash_bytes(*cols: Column | str) -> Column:
    """The same digest as 16 bytes (warehouse form)."""
    return F.unhex(row_hash(*cols))


def row_hash_safe(*cols: Column | str) -> Column:
    """Hash whose parts cannot run into each other: ('1','23') differs from ('12','3')."""
    return F.md5(F.to_json(F.struct(*[col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cols)]),
                           {"ignoreNullFields": "false"}))


# ---- text ----------------------------------------------------------------
def label(sep: str, *cols: Column | str, missing: str | None = None) -> Column:
    """Joined label. NULL parts become ``missing``, or are skipped when that is None."""
    parts = [col(c) if missing is None else F.coalesce(col(c), F.lit(missing)) for c in cols]
    return F.concat_ws(sep, *parts)


def base_code(c: Column | str) -> Column:
    """'B02884' -> 's/b44': class letter by divisor, then at least three hex digits."""
    number = F.substring(col(c), 2, 64).cast("long")
    digits = F.lower(F.hex(number))
    padded = F.when(F.length(digits) < 3, F.lpad(digits, 3, "0")).otherwise(digits)
    letter = F.when(number % 7 == 0, "s").when(number % 3 == 0, "a").otherwise("e")
    return F.concat(letter, F.lit("/"), padded)


@F.pandas_udf(T.StringType())
def base_code_udf(bases: pd.Series) -> pd.Series:
    """Vectorised form of ``base_code`` for callers that need a registered function; NULL gives NULL."""
    number = pd.to_numeric(bases.str[1:]).astype("Int64").dropna()
    letter = pd.Series("e", index=number.index).mask(number % 3 == 0, "a").mask(number % 7 == 0, "s")
    return (letter + "/" + number.map("{:03x}".format)).reindex(bases.index)


def masked(c: Column | str, salt: str = "") -> Column:
    """One-way mask of a sensitive value; equal inputs stay equal."""
    return F.sha2(F.concat(F.lit(salt), col(c).cast("string")), 256)


# ---- numbers -------------------------------------------------------------
def exact_sum(c: Column | str, as_type: T.DecimalType = MONEY) -> Column:
    """Order-independent sum of money: decimal inside, double outside."""
    return F.sum(col(c).cast(as_type)).cast("double")


def exact_avg(c: Column | str, as_type: T.DecimalType = MONEY) -> Column:
    return F.sum(col(c).cast(as_type)).cast("double") / F.count(col(c))


def bucket(c: Column | str, edges: list[float], names: list[str]) -> Column:
    """Right-closed buckets: (-inf, e0], (e0, e1], ..., (en, inf)."""
    out = F.when(col(c) <= edges[0], names[0])
    for edge, name in zip(edges[1:], names[1:]):
        out = out.when(col(c) <= edge, name)
    return out.when(col(c).isNotNull(), names[-1])
