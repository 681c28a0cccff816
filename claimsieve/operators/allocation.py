"""VW-01 and the weighted fan-out from subgroups to groups (JN-05, WN-01).

A subgroup may belong to several groups; each of them gets an equal share. A share depends on the
pair only, so facts are summed per subgroup first and only those sums meet the bridge: the rows
that fan out are subgroups x groups, never facts x groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from claimsieve.operators.skew import join_one_per_key, rows_per_key

TOTAL = DecimalType(28, 2)


def _fixed_weight(pairs: Column, scale: int) -> Column:
    return F.round(F.lit(1).cast("decimal(1,0)") / pairs, scale).cast(DecimalType(scale + 1, scale))


def allocation_weights(bridge: DataFrame, weight_scale: int | None = None) -> DataFrame:
    """One row per (subgroup, group) pair with weight 1 / pairs of the subgroup.

    Pairs without a subgroup share one weight among them. `weight_scale` gives fixed-point weights
    with that many digits instead of doubles.
    """

    def weight(pairs: Column) -> Column:
        exact = F.lit(1.0) / pairs if weight_scale is None else _fixed_weight(pairs, weight_scale)
        return exact.alias("allocation_weight")

    pairs = bridge.select("subgrp_id", "grp_id")
    fan = rows_per_key(pairs, "subgrp_id", "pairs")
    matched = join_one_per_key(pairs, fan, fan, "subgrp_id", "pairs", nulls=True)
    return matched.select("subgrp_id", "grp_id", weight(F.col("pairs")))


def allocate_to_groups(
    bridge: DataFrame, per_subgroup: DataFrame, totals: Sequence[str], weight_scale: int | None = None
) -> DataFrame:
    """Spread each subgroup's totals over its groups and sum them per group.

    Sums are exact decimals, so they do not depend on the order in which rows arrive. Subgroups
    without a group and groups without a counted subgroup do not appear.
    """
    pairs = bridge.select("subgrp_id", "grp_id").filter(F.col("subgrp_id").isNotNull())
    fan = rows_per_key(pairs, "subgrp_id", "pairs")
    count = F.col("pairs")
    shares = []
    for total in totals:
        amount = F.col(total).cast(TOTAL)
        share = amount / count if weight_scale is None else amount * _fixed_weight(count, weight_scale)
        shares.append(share.alias(total))
    per_pair = per_subgroup.join(fan, "subgrp_id").select("subgrp_id", *shares)
    matched = join_one_per_key(pairs, per_pair, fan, "subgrp_id", "pairs")
    return matched.groupBy("grp_id").agg(*(F.sum(total).alias(total) for total in totals))
