"""Relational building blocks of selection, counting and verification, each a lazy DataFrame.

Where order decides, it is total: the caller gives tie-breakers. Joins are equi-joins; interval conditions ride
on an equi key, or on a side whose size is checked before it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if the table has at most ``most`` rows, as configuration tables do; else the plain table."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def first_hit(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order: candidate chains, latest filed, latest success, amendments first."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def top_n(df: DataFrame, strata: list[str], order: list[Column], n: int | Column) -> DataFrame:
    """The first n rows of each stratum in a total order, with their rank."""
    rank = F.row_number().over(Window.partitionBy(*strata).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)


def exact_set_diff(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are missing, unexpected or duplicate: (keys, finding, n). Nulls are keys like any other.
    One shuffle: both sides are counted together."""
    both = expected.select(*keys, F.lit(1).alias("e"), F.lit(0).alias("a")).unionByName(actual.select(*keys, F.lit(0).alias("e"), F.lit(1).alias("a")))
    c = both.groupBy(*keys).agg(F.sum("e").alias("e"), F.sum("a").alias("a"))
    finding = F.array_compact(F.array(F.when((F.col("e") > 0) & (F.col("a") == 0), "missing"), F.when((F.col("e") == 0) & (F.col("a") > 0), "unexpected"), F.when(F.col("a") > 1, "duplicate")))
    return c.select(*keys, F.explode(finding).alias("finding"), F.col("a").alias("n"))


def multiset_diff(expected: DataFrame, actual: DataFrame, columns: list[str]) -> DataFrame:
    """Rows by how many more times they occur in ``actual`` than in ``expected``, where that is not 0."""
    both = expected.select(*columns, F.lit(-1).alias("d")).unionByName(actual.select(*columns, F.lit(1).alias("d")))
    return both.groupBy(*columns).agg(F.sum("d").alias("surplus")).where("surplus <> 0")


def zero_filled_counts(grid: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of ``rows`` for every key of ``grid``, 0 where there are none. Counted before the join."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    return grid.join(counts, keys, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def ordered_concat(df: DataFrame, keys: list[str], order: list[str], value: str, sep: str = ";") -> DataFrame:
    """(keys, joined): the values of each key in order, joined. For cells that are lists by nature."""
    packed = F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("v"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(packed, lambda x: x["v"].cast("string")), sep).alias("joined"))


def distinct_pairs(df: DataFrame, keys: list[str], first: str, second: str, sep: str = ";") -> DataFrame:
    """Positionally aligned lists of the distinct pairs of each key, in the order of the pairs."""
    pairs = F.array_sort(F.collect_set(F.struct(F.col(first).alias("x"), F.col(second).alias("y"))))
    out = df.groupBy(*keys).agg(pairs.alias("p"))
    side = lambda c: F.array_join(F.transform("p", lambda s: s[c].cast("string")), sep)
    return out.select(*keys, side("x").alias(f"{first}_list"), side("y").alias(f"{second}_list"))


def conflicts(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """Keys with more than one distinct value: (keys, n_values)."""
    return df.select(*keys, value.alias("_v")).distinct().groupBy(*keys).agg(F.count("_v").alias("n_values")).where("n_values > 1")


def coverage(rows: DataFrame, evidence: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with has_evidence; evidence is reduced to its keys first, so no row is doubled."""
    found = evidence.select(*keys).distinct().withColumn("has_evidence", F.lit(True))
    return rows.join(found, keys, "left").withColumn("has_evidence", F.coalesce("has_evidence", F.lit(False)))


def without_evidence(rows: DataFrame, evidence: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with no evidence of equal keys; a null equals a null."""
    e = evidence.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_{k}"))
        same = c if same is None else same & c
    return rows.join(e, same, "left_anti")


def in_window(rows: DataFrame, windows: DataFrame, keys: list[str], at: str, after: str, until: str) -> DataFrame:
    """Rows of each key within (after, until] of its windows: an interval join on the key's equality."""
    w = windows.select(*keys, F.col(after).alias("_after"), F.col(until).alias("_until"))
    return rows.join(w, keys).where((F.col(at) > F.col("_after")) & (F.col(at) <= F.col("_until")))


def banded(rows: DataFrame, bands: DataFrame, value: str, low: str, high: str, default: Column, label: str) -> DataFrame:
    """``rows`` with the label of the band [low, high] their value is in, else the default; of several bands the
    lowest, of bands that begin alike the one first by label. The bands are configuration: they become one sorted
    array, which every row is held against where it is, without a shuffle."""
    own = F.struct(F.col(low).alias("low"), F.col(label).alias("label"), F.col(high).alias("high"))
    sorted_bands = bands.where(F.col(low).isNotNull()).agg(F.array_sort(F.collect_list(own)).alias("bands")).scalar()
    held = F.filter("_bands", lambda b: F.col(value).between(b["low"], b["high"]))
    return rows.withColumn("_bands", sorted_bands).withColumn(label, F.coalesce(F.get(held, F.lit(0))["label"], default)).drop("_bands")


def ordered_prefix(base: DataFrame, head: DataFrame, position: str, columns: list[str]) -> DataFrame:
    """Positions at which ``head`` fails to continue ``base``: (position, finding), removed or changed."""
    b = base.select(position, F.struct(*columns).alias("b"))
    h = head.select(position, F.struct(*columns).alias("h"))
    finding = F.when(F.col("h").isNull(), "removed").when(~F.col("b").eqNullSafe(F.col("h")), "changed")
    return b.join(h, position, "left").select(position, finding.alias("finding")).where("finding is not null")


def tree_digest(df: DataFrame, keys: list[str], parts: list[str]) -> DataFrame:
    """(keys, digest, n): SHA-256 over the sorted lines of each key, a line being its parts with NUL between and
    a line feed behind. For listings of files, one row a file."""
    line = F.concat(F.concat_ws("\x00", *[F.col(p).cast("string") for p in parts]), F.lit("\n"))
    lines = F.array_join(F.array_sort(F.collect_list(line)), "")
    return df.groupBy(*keys).agg(F.sha2(lines, 256).alias("digest"), F.count("*").alias("n"))


def within_tolerance(expected: str, actual: str, tolerance: str) -> Column:
    """True where numbers differ by no more than the tolerance, or, with tolerance 'exact', texts are equal.
    What is no number, or missing, is not within."""
    num = lambda c: F.expr(f"try_cast({c} as decimal(38,18))")
    close = F.abs(num(expected) - num(actual)) <= num(tolerance)
    return F.coalesce(F.when(F.col(tolerance) == "exact", F.col(expected) == F.col(actual)).otherwise(close), F.lit(False))


def exact_partition(whole: str, left: str, right: str) -> Column:
    """True where two arrays share nothing and together are the whole, each without repeats."""
    w, a, b = F.col(whole), F.col(left), F.col(right)
    same = (F.size(F.array_except(w, F.array_union(a, b))) == 0) & (F.size(F.array_except(F.array_union(a, b), w)) == 0)
    return same & (F.size(F.array_intersect(a, b)) == 0) & (F.size(a) + F.size(b) == F.size(w))


def ratio(numerator: Column, denominator: Column) -> Column:
    """A quotient of 18 decimal places; null for a missing or zero denominator. Both sides are taken in ten-thousandths,
    or as whole numbers if one has more than 16 digits before the point; such wide integers keep all places."""
    exact = [c.cast("decimal(24,4)") for c in (numerator, denominator)]
    unit = F.when(F.greatest(*[F.abs(c) for c in exact]) < F.lit(10**16), F.lit(10_000)).otherwise(F.lit(1)).cast("decimal(5,0)")
    n, d = [(c * unit).cast("decimal(20,0)") for c in exact]
    return n / F.nullif(d, F.lit(0).cast("decimal(20,0)"))


def growth(now: Column, before: Column) -> Column:
    return ratio(now - before, before)
