"""Joins that survive a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "__salt"


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    salt_by: Sequence[str],
    slices: int = 16,
) -> DataFrame:
    """Joins ``right``, unique on ``on``, so that one key's rows spread over several tasks.

    The salt is a hash of columns of ``left``, so a task that runs again sends every row
    where it went before; ``right`` is repeated once per slice. As both sides are shuffled
    for this join alone, adaptive execution can split a slice that is still too large, which
    it could not do were ``right`` an aggregate that is partitioned by the key already. It may
    also turn the join into a broadcast when ``right`` proves small.
    """
    # The coalesce says that a salt is never NULL. Otherwise the planner filters ``left`` by
    # it, and no longer sees that ``right`` may be built on the same rows.
    salt = F.coalesce(F.pmod(F.xxhash64(*salt_by), F.lit(slices)).cast("int"), F.lit(0))
    salted = left.withColumn(_SALT, salt)
    copies = right.withColumn(_SALT, F.explode(F.array(*(F.lit(i) for i in range(slices)))))
    return salted.join(copies, [*on, _SALT], how).drop(_SALT)
