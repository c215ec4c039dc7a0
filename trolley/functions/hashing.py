"""Repeatable pseudo-random choices.

``DataFrame.sample`` and ``randomSplit`` depend on how rows are partitioned.
Everything here depends only on the values of a row, so a sample or a split is
the same on one core, on a cluster, and after a lost executor is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_digest(seed: int, *keys: str | Column) -> Column:
    """MD5 text of the seed and the keys; sorting by it shuffles rows repeatably."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[_text(k) for k in keys]))


def digest_number(digest: Column, hex_digits: int = 8) -> Column:
    """The leading hex digits of a digest as a long (at most 15 digits)."""
    return F.conv(F.substring(digest, 1, hex_digits), 16, 10).cast("long")


def below_fraction(digest: Column, fraction: float) -> Column:
    """True for about ``fraction`` of all digests."""
    if fraction >= 1.0:
        return F.lit(True)
    limit = format(int(fraction * 16**8), "08x")
    return F.substring(digest, 1, 8) < F.lit(limit)


def row_text(columns: list[str]) -> Column:
    """One text per row; two rows give the same text only if all columns are equal.

    Each value is written as ``length:value``; null is written as ``-``.
    """
    parts = []
    for name in columns:
        value = F.col(f"`{name}`").cast("string")
        parts.append(F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.concat(*parts)


def _text(key: str | Column) -> Column:
    column = F.col(key) if isinstance(key, str) else key
    return column.cast("string")
