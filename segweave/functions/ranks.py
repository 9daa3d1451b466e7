"""Exact order statistics of groups of any size.

A group of up to `most` rows is ordered as a whole, by counts of its distinct
values. Of a larger one a quantile sketch gives a bracket around each wanted
rank; what lies below the bracket is only counted, and only the values inside,
some thousandths of the group, are ordered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a group that is ordered whole; half width of a bracket, as a share of the rows, and the sketch's accuracy: its error is a tenth of that.
MOST, WIDTH, ACCURACY = 100_000, 0.002, 5000


def ranks(df: DataFrame, keys: list[str], value: str, wanted: dict[str, tuple[float, str]], most: int = MOST) -> DataFrame:
    """One row a group: n (non-null values) and for each name the value at rank q.

    Rules: nearest (q * (n - 1), halves to even), floor (q * n), median (mean
    of the two middle values). Null keys are a group.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    edges = [min(1.0, max(0.0, q + side)) for q, _ in wanted.values() for side in (-WIDTH, WIDTH)]
    info = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", edges, ACCURACY).alias("_e"))
    bracket = lambda k, low, high: F.struct(F.lit(k).alias("slot"), low.alias("low"), high.alias("high"))
    whole = F.array(bracket(0, F.lit(float("-inf")), F.lit(float("inf"))))
    parts = F.array(*[bracket(k, F.col("_e")[2 * k], F.col("_e")[2 * k + 1]) for k in range(len(wanted))])
    info = info.select(*[F.col(k).alias(f"_{k}") for k in keys], "_n", F.when(F.col("_n") <= most, whole).otherwise(parts).alias("_b"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    slots = rows.join(info, same).select(*keys, "_n", "_v", F.explode("_b").alias("_b")).where("_v <= _b.high")
    # what lies below a bracket is one null, which is ordered first
    counts = slots.groupBy(*keys, "_n", F.col("_b.slot").alias("_slot"), F.when(F.col("_v") >= F.col("_b.low"), F.col("_v")).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    at = counts.select("*", F.sum("_c").over(Window.partitionBy(*keys, "_slot").orderBy(F.col("_v").asc_nulls_first())).alias("_upto"))
    n = F.col("_n")

    def index(q, rule):
        return {"nearest": lambda: F.bround((n - 1) * F.lit(q), 0), "floor": lambda: F.least(n - 1, F.floor(n * F.lit(q)))}[rule]()

    def pick(i, k):
        return F.min(F.when((F.col("_upto") > i) & ((F.col("_slot") == k) | (n <= most)), F.col("_v")))

    out = [((pick(F.floor((n - 1) / 2), k) + pick(F.ceil((n - 1) / 2), k)) / 2 if rule == "median" else pick(index(q, rule), k)).alias(name) for k, (name, (q, rule)) in enumerate(wanted.items())]
    return at.groupBy(*keys).agg(F.max("_n").alias("n"), *out)
