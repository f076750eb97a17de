"""Sainte-Laguë apportionment as a DataFrame operator.

Seats go to the highest quotients weight / (2k + 1). All seats but a few follow from
rounding weight / divisor; the rest are settled among as many quotients as can matter,
so the rows made are in proportion to the claimants, whatever the seats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sainte_lague(claims: DataFrame, group: list[str], key: list[str], weight: str, seats: str) -> DataFrame:
    """claims with a long column `quota`: within each group, `seats` (equal on all rows
    of the group) split by `weight`. Ties go to the smaller key. Null or negative weights count as 0, and without
    any weight all quotas are 0."""
    own = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    w = F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0))
    c = claims.withColumn("_w", w).withColumn("_sum", F.sum("_w").over(own)).withColumn("_n", F.count("*").over(own))
    share = F.when(F.col("_sum") > 0, F.col("_w") * F.col(seats) / F.col("_sum")).otherwise(0.0)
    c = c.withColumn("_first", F.floor(share + 0.5).cast("long"))
    total = F.when(F.col("_sum") > 0, F.col(seats)).otherwise(0)
    c = c.withColumn("_lack", (total - F.sum("_first").over(own)).cast("long"))
    # A claimant can win or lose about its share of what is lacking, and one or two more.
    tries = F.when(F.col("_lack") == 0, 0).otherwise(F.ceil(1.5 * F.col("_n") * F.col("_w") / F.greatest("_sum", F.lit(1e-300))) + 2)
    tries = F.when(F.col("_lack") < 0, F.least(tries, F.col("_first"))).otherwise(F.when(F.col("_w") > 0, tries).otherwise(0))
    steps = c.withColumn("_tries", tries.cast("int")).filter("_tries > 0").select(
        *group, *key, "_w", "_first", "_lack", F.explode(F.sequence(F.lit(1), "_tries")).alias("_k")
    )
    seat = F.when(F.col("_lack") > 0, F.col("_first") + F.col("_k") - 1).otherwise(F.col("_first") - F.col("_k"))
    quotient = F.col("_w") / (2 * seat + 1)
    order = F.when(F.col("_lack") > 0, -quotient).otherwise(quotient)
    ranked = steps.withColumn("_order", order).withColumn("_rank", F.row_number().over(own.orderBy("_order", *key)))
    moved = ranked.filter("_rank <= abs(_lack)").groupBy(*group, *key).agg(F.sum(F.signum("_lack")).cast("long").alias("_moved"))
    on = [F.col(f"c.{k}").eqNullSafe(F.col(f"m.{k}")) for k in [*group, *key]]
    cond = on[0]
    for x in on[1:]:
        cond = cond & x
    out = c.alias("c").join(moved.alias("m"), cond, "left")
    return out.select(*(F.col(f"c.{x}") for x in claims.columns), (F.col("c._first") + F.coalesce(F.col("m._moved"), F.lit(0))).alias("quota"))
