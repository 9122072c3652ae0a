"""Joins of many rows with few rows a key, where one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scalar

# Rows of one key that go to one task; a key with more is dealt to several.
SPREAD_ROWS = 1_000_000
# The list of such keys is broadcast up to this many rows.
SPREAD_BROADCAST_ROWS = 2_000_000


def spread_join(rows: DataFrame, other: DataFrame, key: str, by: str, sizes: DataFrame | None = None,
                n: str = "n_ratings", how: str = "inner", most: int | None = None) -> DataFrame:
    """``rows`` joined with ``other`` on ``key``; the rows of a large key are dealt by ``by``, with a copy of its other rows to each share.

    ``sizes`` has one row a key, with the number ``n`` of its rows (default:
    ``other``). It is read for the large keys and should be a stored table. Where
    no key has more than ``most`` rows this is a plain join.
    """
    most = SPREAD_ROWS if most is None else most
    sizes = other if sizes is None else sizes
    shares = F.ceil(F.col(n) / F.lit(most)).cast("int")
    large = sizes.filter(F.col(n) > most).select(key, shares.alias("n_shares"))
    n_large = scalar(large.agg(F.count(F.lit(1))))
    if not n_large:
        return rows.join(other, key, how)
    large = F.broadcast(large) if n_large <= SPREAD_BROADCAST_ROWS else large
    own = F.when(F.col("n_shares").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(by), F.col("n_shares")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("n_shares"), F.lit(1)) - 1))
    dealt = rows.join(large, key, "left").select(*rows.columns, own.alias("share"))
    copied = other.join(large, key, "left").select(*other.columns, every.alias("share"))
    return dealt.join(copied, [key, "share"], how).drop("share")
