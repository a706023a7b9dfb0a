"""Skew-tolerant equi-join.

When one key holds a large share of the rows on one side (a keyword that
is the top search of a third of all users), a hash join sends all of them
to one reducer. ``salted_join`` spreads the big side of every key over
``buckets`` reducers: the big side gets a salt derived from a hash of its
own columns -- deterministic, so a retried task after a lost executor
routes every row exactly as before -- and the small side, unique per key,
is replicated once per salt value. The small side's volume grows by
``buckets``; the big side is not replicated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "_salt"


def salted_join(big: DataFrame, small: DataFrame, keys: Sequence[str], buckets: int,
                how: str = "inner", salt_from: Sequence[str] | None = None) -> DataFrame:
    """``big.join(small, keys, how)`` with the big side's keys salted.

    ``how`` must keep the big side's rows (inner or left). ``salt_from``:
    columns hashed for the salt (default: all of the big side's columns).
    """
    if how not in ("inner", "left", "left_outer"):
        raise ValueError("salted_join supports inner and left joins")
    if buckets <= 1:
        return big.join(small, list(keys), how)
    cols = list(salt_from or big.columns)
    b = big.withColumn(_SALT, F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int"))
    s = small.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return b.join(s, list(keys) + [_SALT], how).drop(_SALT)
