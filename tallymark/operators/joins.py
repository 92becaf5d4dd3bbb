"""Joins in forms that skew handling can split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def outer_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on equal keys: a left join, and the rows of the right side without a partner.

    Spark can split a hot key on the left of a left join or an anti join, but not in a full
    outer join.  The anti join looks at distinct keys only.  Null keys have no partner.
    """
    keys = list(keys)
    right_only = right.join(left.select(*keys).distinct(), keys, "left_anti")
    return left.join(right, keys, "left").unionByName(right_only, allowMissingColumns=True)
