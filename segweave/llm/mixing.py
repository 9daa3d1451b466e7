"""Mixing sources to target weights by Pareto order sampling, in DataFrame expressions alone.

A source's target is its share of the mix by weight, capped at a multiple of
its own size, the excess shared again by weight. The whole part of target /
source size is certain, whole copies of every document; the rest is drawn with
Pareto order sampling: documents rank by the odds of a uniform number over
their inclusion odds, the lowest first, and enter until the words are reached,
which fixes the sample's size. Inclusion odds are unequal: in proportion to a document's
size over the mean of its source, from a half to twice (`LEAST`, `MOST`), as
long documents cost less overhead a word. A factor that all of a source share
doesn't change their order, so the odds need no scale. The uniform number is a
hash of doc_id, so reruns agree.

No source is ever sorted as a whole: a histogram of the ranks (as rank / (1 +
rank)) finds the bin in which a source's last sampled document lies, and only that bin is ordered.

A null doc_id is drawn by its text; rows that share both are one document
repeated and are taken or left together. Null and empty texts have size 0 and
take 0. Null sources are one source, the last. An empty table gives no row.
Extra columns are carried along by `copies` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared

#: Bits of the uniform number, and of its histogram bin.
DRAW_BITS, BIN_BITS = 52, 12
#: Least and greatest inclusion odds of a document.
LEAST, MOST = 0.5, 2.0
#: Sources up to which their table is broadcast.
BROADCAST_SOURCES = 100_000
_SIZE = "coalesce(regexp_count(text, '[^ \\\\t\\\\n\\\\x0B\\\\f\\\\r]+'), 0)"
_DRAW = f"cast(conv(substr(md5(coalesce(cast(doc_id AS string), md5(coalesce(text, '')))), 1, {DRAW_BITS // 4}), 16, 10) AS long)"


def sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.expr(_SIZE).cast("long").alias("size"), F.expr(_DRAW).alias("draw"))


def targets(totals: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """source, source_size, target: weights repeat over the sources by code point, null last.

    Ordered by cap / weight, sources fill up one after another; the first that
    doesn't reach its cap gives the level of all that follow.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.get(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights))
    t = totals.select(*totals.columns, w.alias("w"), (F.col("source_size") * most).alias("cap"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    every, before = Window.partitionBy(F.lit(1)), by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    t = t.select("*", F.row_number().over(by_ratio).alias("k"), ((F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))).alias("level"))
    open_ = F.col("level") * F.col("w") < F.col("cap")
    t = t.select("*", F.min(F.when(open_, F.struct("k", "level"))).over(every).alias("at"))
    filled = F.col("at").isNull() | (F.col("k") < F.col("at.k"))
    return t.select(*totals.columns, F.when(filled, F.col("cap").cast("double")).otherwise(F.col("at.level") * F.col("w")).alias("target"))


def _ranked(rows: DataFrame) -> DataFrame:
    """rows (draw, size, mean of the source) with their Pareto rank and its histogram bin."""
    u = (F.col("draw") + F.lit(0.5)) / F.lit(float(1 << DRAW_BITS))
    odds = F.least(F.lit(MOST), F.greatest(F.lit(LEAST), F.coalesce(F.try_divide(F.col("size"), F.col("mean")), F.lit(1.0))))
    rows = rows.withColumn("rank", u / (1 - u) / odds)
    return rows.withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * F.lit(float(1 << BIN_BITS))))


def thresholds(light: DataFrame, goal: DataFrame) -> DataFrame:
    """goal with copies (certain ones), edge_bin and last_rank: documents of lower bins, and of that one up to that rank, enter the sample."""
    per = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    goal = goal.withColumn("copies", F.floor(per)).withColumn("need", F.col("target") - F.col("copies") * F.col("source_size"))
    ranked = _ranked(_with(light, goal.select("source", "mean")))
    bins = ranked.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    so_far = Window.partitionBy("source").orderBy("bin")
    bins = _with(bins.withColumn("upto", F.sum("words").over(so_far)), goal.select("source", "need"))
    edge = bins.where((F.col("need") > 0) & (F.col("upto") > F.col("need")) & (F.col("upto") - F.col("words") <= F.col("need"))).select("source", F.col("bin").alias("edge_bin"), (F.col("need") - F.col("upto") + F.col("words")).alias("rest"))
    by_rank = Window.partitionBy("source").orderBy("rank")
    inside = _with(ranked, edge).where("bin = edge_bin").withColumn("upto", F.sum("size").over(by_rank))
    last = inside.groupBy("source").agg(F.max(F.when(F.col("upto") - F.col("size") / 2 <= F.col("rest"), F.col("rank"))).alias("last_rank"), F.first("edge_bin").alias("edge_bin"))
    none = F.when(F.col("need") > 0, F.lit(1 << BIN_BITS)).otherwise(F.lit(-1))  # no edge: all or none
    return goal.join(last.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").select("source", "source_size", "mean", "target", "copies", F.coalesce("edge_bin", none).alias("edge_bin"), F.coalesce("last_rank", F.lit(-1.0)).alias("last_rank"))


def _with(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """rows joined with the table of sources, broadcast if it is counted and small."""
    sources = F.broadcast(sources) if sources.count() <= BROADCAST_SOURCES else sources
    return rows.alias("r").join(sources.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")), "inner").select("r.*", *[f"s.{c}" for c in sources.columns if c != "source"])


def plan(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> tuple[DataFrame, DataFrame]:
    """The staged light rows (doc_id, source, size, draw) and the table of sources with their thresholds."""
    light = shared.staged(sizes(docs), "mix-sizes")
    totals = light.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    goal = targets(totals, weights, share, most).withColumn("mean", F.col("source_size") / F.col("docs"))
    goal = shared.staged(goal.select("source", "source_size", "mean", "target"), "mix-targets")
    return light, shared.staged(thresholds(light, goal), "mix-thresholds")


def _times(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """rows (source, size, draw) with the columns of their source, rank and times, the number of copies."""
    drawn = (F.col("bin") < F.col("edge_bin")) | ((F.col("bin") == F.col("edge_bin")) & (F.col("rank") <= F.col("last_rank")))
    return _ranked(_with(rows, sources)).withColumn("times", F.col("copies") + drawn.cast("long"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """doc_id, size, source_size, target, taken, times, rank: how often each document enters the mix, and its Pareto rank."""
    rows = _times(*plan(docs, weights, share, most))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times", "rank")


def copies(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """The mix itself: rows of docs, each as often as it is taken."""
    _, sources = plan(docs, weights, share, most)
    packed = docs.select(F.struct("*").alias("_row"), "source", F.expr(_SIZE).cast("long").alias("size"), F.expr(_DRAW).alias("draw"))
    return _times(packed, sources).where("times > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("_row.*")
