"""Scalar expressions over columns: names, codes, rounding, spans of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filled(c: Column | str) -> Column:
    """Empty strings are as good as null."""
    return F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(""))


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 of nothing."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "-"), "^-|-$", "")


def segment_id(group: Column, stem: Column, index: Column) -> Column:
    return F.format_string("%s__%s__%04d", group, slug(stem), index)


def clip_name(segment: Column, start_sample: Column, end_sample: Column, rate: Column) -> Column:
    """Segment id with its bounds in whole milliseconds, halves to even."""
    ms = lambda s: F.bround(s * F.lit(1000.0) / rate, 0).cast("long")
    return F.format_string("%s__%08d-%08d", segment, ms(start_sample), ms(end_sample))


def shard_path(source_id: Column) -> Column:
    return F.concat(F.lit("data/"), source_id, F.lit(".parquet"))


def shard_source(path: Column) -> Column:
    """The inverse of shard_path; null for any other path."""
    m = lambda k: F.regexp_extract(path, r"^data/([^/]+)/([^/]+)\.parquet$", k)
    return F.when(m(1) != "", F.concat(m(1), F.lit("/"), m(2)))


def stem_number(stem: Column) -> Column:
    """All digits of the stem as one number, null without any."""
    return F.nullif(F.regexp_replace(stem, r"\D", ""), F.lit("")).cast("int")


def letters(n: Column) -> Column:
    """0 to a, 25 to z, 26 to aa, 701 to zz, 702 to aaa, and so on for any whole number."""
    out, rest = F.chr(F.lit(97) + n % 26), F.floor(n / 26)
    for _ in range(6):  # 27 to the 7th exceeds every int
        out = F.when(rest > 0, F.concat(F.chr(F.lit(97) + (rest - 1) % 26), out)).otherwise(out)
        rest = F.when(rest > 0, F.floor((rest - 1) / 26)).otherwise(F.lit(0))
    return out


def thousandths(c: Column) -> Column:
    """A double to three decimals as its exact binary value rounds, halves to even.

    The product with 1000 is taken in two parts: what its rounding lost decides where it seems to be a half.
    """
    product = c * F.lit(1000.0)
    high = c * F.lit(134217729.0) - (c * F.lit(134217729.0) - c)
    lost = (high * F.lit(1000.0) - product) + (c - high) * F.lit(1000.0)
    low = F.floor(product).cast("double")
    half = product - low == F.lit(0.5)
    whole = F.when(half & (lost > 0), low + 1).when(half & (lost < 0), low).otherwise(F.rint(product))
    return whole / F.lit(1000.0)


def tokens(c: Column) -> Column:
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda w: w != "")


def distance(a: Column, b: Column) -> Column:
    """Edit distance over the longer one's code points; 0 of two empty strings."""
    return F.coalesce(F.try_divide(F.levenshtein(a, b).cast("double"), F.greatest(F.char_length(a), F.char_length(b))), F.lit(0.0))


def surah_list(raw: Column, total: Column) -> Column:
    """Numbers of a comma list, distinct and ascending; 1..total (114) if it has none."""
    found = F.transform(F.filter(F.split(F.coalesce(raw, F.lit("")), ","), lambda p: F.trim(p).rlike("^[0-9]+$")), lambda p: F.trim(p).cast("int"))
    every = F.sequence(F.lit(1), F.coalesce(F.nullif(total, F.lit(0)), F.lit(114)))
    return F.when(F.size(found) > 0, F.array_sort(F.array_distinct(found))).otherwise(every)


def excerpts(duration: Column, count: int, clip: float) -> Column:
    """Array of (name, at) of short looks into a recording."""
    one = lambda name, at: F.struct(F.lit(name).alias("name"), at.alias("at"))
    last = duration - clip
    spots = F.array_sort(F.transform(F.slice(F.array(*map(F.lit, (0.02, 0.5, 0.92, 0.25, 0.75))), 1, count), lambda s: F.greatest(F.lit(0.0), F.least(last, duration * s))))
    names = {3: ("start", "middle", "end")}.get(count)
    named = F.transform(spots, lambda at, i: F.struct((F.get(F.array(*map(F.lit, names)), i) if names else F.concat(F.lit("@"), F.bround(at, 0).cast("long").cast("string"), F.lit("s"))).alias("name"), at.alias("at")))
    return F.when(duration <= 1.5 * clip, F.array(one("whole", F.lit(0.0)))).when(F.lit(count <= 1), F.array(one("middle", last / 2))).otherwise(named)


def trimmed(hits: Column, n: Column, slack: int = 10) -> Column:
    """hits without those far from the upper median."""
    middle = F.get(F.array_sort(hits), F.floor(F.size(hits) / 2).cast("int"))
    return F.when(F.size(hits) < 2, hits).otherwise(F.filter(hits, lambda h: F.abs(h - middle) <= F.greatest(3 * n, n + slack)))


def bounded_span(hits: Column, most: int) -> Column:
    """(start, end) of the hits, of the first densest window if they spread over `most` words or more."""
    s = F.array_sort(hits)
    pair = lambda a, b: F.struct(a.cast("int").alias("start"), b.cast("int").alias("end"))
    windows = F.transform(s, lambda low: F.struct(F.size(F.filter(s, lambda h: (h >= low) & (h < low + most))).alias("n"), (-low).alias("first"), F.array_max(F.filter(s, lambda h: (h >= low) & (h < low + most))).alias("last")))
    best = F.array_max(windows)
    whole = F.element_at(s, -1) - F.get(s, F.lit(0)) < most
    return F.when(F.size(hits) == 0, pair(F.lit(-1), F.lit(-1))).when(whole, pair(F.get(s, F.lit(0)), F.element_at(s, -1) + 1)).otherwise(pair(-best["first"], best["last"] + 1))


def joined(words: Column, start: Column, end: Column) -> Column:
    """Words of [start, end), clamped, with single spaces."""
    a, b = F.greatest(start, F.lit(0)), F.least(end, F.size(words))
    return F.when(b > a, F.array_join(F.slice(words, a + 1, F.greatest(b - a, F.lit(0))), " ")).otherwise(F.lit(""))


def runs(values: Column) -> Column:
    """values without those equal to the one before."""
    return F.filter(values, lambda v, i: (i == 0) | (v != F.get(values, i - 1)))


def let(value: Column, told) -> Column:
    """told(value), with value computed once a row; a column that a lambda names may be computed again for each element."""
    return F.get(F.transform(F.array(value), told), F.lit(0))


def exploded(df: DataFrame, values: str, at: str, *keep: str) -> DataFrame:
    """df's rows for each of the values, a struct, with its place and fields; unlike an inner explode it has the values computed once."""
    rows = df.select(*keep, F.posexplode_outer(values).alias(at, "_s")).where(F.col(at).isNotNull())
    return rows.select(*keep, at, "_s.*")
