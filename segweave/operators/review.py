"""Selections for human review, and what is still to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import filled


def pick(rows: DataFrame, by: str, n: int, largest: bool, order: str) -> DataFrame:
    """The n rows of largest or smallest duration or distance; ties by `order`."""
    column = {"duration": "duration_seconds", "distance": "align_distance"}[by]
    good = F.col(column).isNotNull()
    if by == "distance":
        good &= filled("asr").isNotNull() & filled("label").isNotNull()
    return rows.where(good).orderBy(F.desc(column) if largest else F.asc(column), order).limit(n)


def unlabelled(rows: DataFrame, n: int, order: str) -> DataFrame:
    return rows.where(filled("label").isNull()).orderBy(F.coalesce("duration_seconds", F.lit(0.0)).desc(), order).limit(n)


def sections(rows: DataFrame, names: list[str], n: int, order: str) -> DataFrame:
    """Tagged rows of the sections long, short, worst and nolabel."""
    make = {"long": lambda: pick(rows, "duration", n, True, order), "short": lambda: pick(rows, "duration", n, False, order), "worst": lambda: pick(rows, "distance", n, True, order), "nolabel": lambda: unlabelled(rows, n, order)}
    if unknown := set(names) - set(make):
        raise ValueError(f"no such section: {', '.join(sorted(unknown))}")
    out = None
    for k, name in enumerate(names):
        part = make[name]().withColumn("section", F.lit(name)).withColumn("section_ord", F.lit(k))
        out = part if out is None else out.unionByName(part)
    return out


def by_group(rows: DataFrame, group: str | None) -> DataFrame:
    return rows.where(F.col("reciter_slug") == group) if group else rows


def within(rows: DataFrame, least: float = 0.0, most: float | None = None) -> DataFrame:
    """Rows whose duration lies in [least, most]."""
    d = F.col("duration_seconds")
    return rows.where(d.isNotNull() & (d >= least) & (F.lit(True) if most is None else d <= most))


def groups(rows: DataFrame) -> DataFrame:
    return rows.select(filled("reciter_slug").alias("reciter_slug")).where("reciter_slug IS NOT NULL").distinct()


def previous_ids(rows: DataFrame, key: str = "segment_id") -> DataFrame:
    """Each row's predecessor in its recording; rows without recording or index have none and are none."""
    ok = rows.where("source_id IS NOT NULL AND index IS NOT NULL")
    return ok.select(key, F.lag(key).over(Window.partitionBy("source_id").orderBy("index", "ord")).alias("previous_id")).where("previous_id IS NOT NULL")


def overlaps(spans: DataFrame) -> DataFrame:
    """Share of the shorter of two consecutive spans of a document that both cover."""
    w = Window.partitionBy("doc_id").orderBy("k")
    nxt = spans.select("*", F.lead("span_start").over(w).alias("next_start"), F.lead("span_end").over(w).alias("next_end"))
    common = F.least("span_end", "next_end") - F.greatest("span_start", "next_start")
    size = F.least(F.col("span_end") - F.col("span_start"), F.col("next_end") - F.col("next_start"))
    return nxt.where(common > 0).select("doc_id", "k", F.round(common / size, 9).alias("share"))


def pending(sources: DataFrame, done: DataFrame, published: DataFrame, stale: DataFrame | None = None) -> DataFrame:
    """Sources neither done nor published (stale ones aren't counted as published)."""
    out = published if stale is None else published.join(stale, "source_id", "left_anti")
    return sources.join(done.select("source_id").union(out.select("source_id")).distinct(), "source_id", "left_anti")


def stale_sources(rows: DataFrame, column: str) -> DataFrame:
    """Sources in which `column` is null or empty throughout."""
    return rows.groupBy("source_id").agg(F.count(filled(column)).alias("filled")).where("filled = 0").select("source_id")
