"""Hash-derived uniforms and buckets.

Noise, folds and shuffles come from hashes of keys, never from ``rand()`` or
row order, so the answer is the same in every partition layout and in the SQL
oracle. ``u(tag, key)`` takes the first 8 hex digits of
``md5(tag || '-' || key)`` as an unsigned 32-bit integer divided by 2**32.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(key) -> Column:
    return F.col(key) if isinstance(key, str) else key


def hash32(tag: str, key) -> Column:
    """Unsigned 32-bit integer from md5 of ``tag-key`` (as bigint)."""
    digest = F.md5(F.concat(F.lit(tag), F.lit("-"), _as_col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def u(tag: str, key) -> Column:
    """Deterministic uniform in [0, 1) keyed by ``tag`` and ``key``."""
    return hash32(tag, key).cast("double") / F.lit(4294967296.0)


def bucket(tag: str, key, m: int) -> Column:
    """Deterministic bucket in [0, m) for k-fold and split assignment."""
    return F.pmod(hash32(tag, key), F.lit(m)).cast("int")


def u_sql(tag: str, key_sql: str) -> str:
    """DuckDB spelling of :func:`u` (used by the oracle SQL)."""
    return (f"((('0x'||substr(md5('{tag}'||'-'||cast({key_sql} as varchar)),1,8))::BIGINT)"
            f"::double/4294967296.0)")


def bucket_sql(tag: str, key_sql: str, m: int) -> str:
    return (f"cast(((('0x'||substr(md5('{tag}'||'-'||cast({key_sql} as varchar)),1,8))"
            f"::BIGINT) % {m}) as integer)")
