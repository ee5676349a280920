"""Column-name rules."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

_SPLITS = (re.compile(r"([a-z0-9])([A-Z])"), re.compile(r"([A-Z]+)([A-Z][a-z])"))


def snake_case(name: str) -> str:
    """``Trip_Pickup_DateTime`` -> ``trip_pickup_date_time``; ``PULocationID`` -> ``pu_location_id``."""
    for rule in _SPLITS:
        name = rule.sub(r"\1_\2", name)
    return re.sub(r"[^0-9A-Za-z]+", "_", name).strip("_").lower()


def snake_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(c) for c in df.columns])


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Names that both frames have, in the order of ``left``."""
    shared = set(right.columns)
    return [c for c in left.columns if c in shared]
