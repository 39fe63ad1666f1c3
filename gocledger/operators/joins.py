"""Join helpers with an explicit size check before any broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_bytes(schema: T.StructType) -> int:
    """Upper estimate of a row's bytes in memory: 16 per field, 40 for a string."""
    return sum(40 if isinstance(f.dataType, T.StringType) else 16 for f in schema) + 16


def fits_broadcast(small: DataFrame, small_rows: int, max_bytes: int) -> bool:
    """Whether ``small`` with its measured row count stays within the broadcast bound."""
    return small_rows * row_bytes(small.schema) <= max_bytes


def bounded_broadcast_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str,
    *,
    small_rows: int,
    max_bytes: int,
    salt_buckets: int,
    salt_key: str,
) -> DataFrame:
    """Join ``big`` to a dimension-like ``small`` side.

    ``small_rows`` is the measured row count of ``small`` (the caller holds it
    materialised).  Within ``max_bytes`` the small side is broadcast: the big side
    keeps its partitioning and no shuffle happens.  Above it, both sides are
    shuffled on ``on + salt``: the big side gets ``salt = pmod(hash(salt_key), n)``
    and the small side is replicated once per salt value, so a key that holds a
    large share of the big side (a hot GoC) is spread over ``n`` tasks instead of
    one.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner/left joins keep the big side's rows whole")
    if fits_broadcast(small, small_rows, max_bytes):
        return big.join(F.broadcast(small), list(on), how)
    n = max(int(salt_buckets), 1)
    salted_big = big.withColumn("_salt", F.pmod(F.hash(F.col(salt_key)), F.lit(n)))
    salted_small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return salted_big.join(salted_small, [*on, "_salt"], how).drop("_salt")
