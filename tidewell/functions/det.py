"""Deterministic pseudo-random numbers from a hash, equal on every engine and retry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash52(key, salt: str = "") -> Column:
    """52-bit integer from the md5 of ``salt`` and ``key``."""
    text = F.concat(F.lit(salt), _col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def uniform(key, salt: str = "") -> Column:
    """Uniform number in [0, 1)."""
    return hash52(key, salt) / F.lit(float(2**52))


def hash52_sql(key: str, salt: str = "") -> str:
    return f"('0x' || substr(md5('{salt}' || CAST({key} AS VARCHAR)), 1, 13))::BIGINT"


def uniform_sql(key: str, salt: str = "") -> str:
    return f"({hash52_sql(key, salt)} / 4503599627370496.0)"
