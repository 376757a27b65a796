"""Exact running totals and quantiles without a large window.

``running_totals`` orders rows by a numeric column (optionally within groups) and
cuts the order into ranges at approximate quantiles: FAN ranges, and each of those
into as many again until a range holds WINDOW_ROWS rows or so. A range is a window
of its own; the totals of the ranges before it are scanned level by level, in
windows of at most FAN + 1 rows. Totals are exact; the approximation only balances
the work."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a range, and ranges that a level cuts a range into.
WINDOW_ROWS, FAN = 250_000, 256


def _fractions(fan: int) -> list[float]:
    return [i / fan for i in range(1, fan)]


def _place(bounds: Column, x: Column, descending: bool) -> Column:
    hit = (lambda b: b >= x) if descending else (lambda b: b < x)
    return F.size(F.filter(F.array_distinct(bounds), hit)).cast("int")


def _ranges(df: DataFrame, col: str, descending: bool, window_rows: int, fan: int) -> tuple[DataFrame, list[str]]:
    """``df`` with a column for each level of its ranges. The first level's bounds
    are a small array in the plan; a further level has an array for each range."""
    x = F.col(col)
    found = df.agg(F.count(x).alias("n"), F.percentile_approx(col, _fractions(fan), 10000).alias("b")).first()
    bounds = F.array(*[F.lit(float(v)) for v in found["b"]]) if found["b"] else F.array().cast("array<double>")
    df, levels, wide = df.withColumn("_b1", _place(bounds, x, descending)), ["_b1"], found["n"] / fan
    while wide > window_rows:
        inner = df.groupBy(*levels).agg(F.percentile_approx(col, _fractions(fan), 1000).alias("_bounds"))
        name = f"_b{len(levels) + 1}"
        df = df.join(inner, levels).withColumn(name, _place(F.col("_bounds"), x, descending)).drop("_bounds")
        levels, wide = [*levels, name], wide / fan
    return df, levels


def range_offsets(totals: DataFrame, groups: list[str], levels: list[str], value_cols: list[str], prefix: str = "_o_") -> DataFrame:
    """``totals``: a row for each (groups, levels). Returns the sums of all ranges
    before each one: at every level those before it under the same parent."""
    out = None
    for i, level in enumerate(levels):
        upto = levels[:i + 1]
        sums = totals.groupBy(*groups, *upto).agg(*[F.sum(v).alias(v) for v in value_cols])
        w = (Window.partitionBy(*groups, *levels[:i]) if groups or i else Window).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
        part = sums.select(*groups, *upto, *[F.coalesce(F.sum(v).over(w), F.lit(0)).alias(f"_p{i}_{v}") for v in value_cols])
        out = part if out is None else out.join(part, [*groups, *levels[:i]])
    return out.select(*groups, *levels, *[sum((F.col(f"_p{i}_{v}") for i in range(1, len(levels))), F.col(f"_p0_{v}")).alias(f"{prefix}{v}") for v in value_cols])


def running_totals(df: DataFrame, order_col: str, value_cols: list[str], descending: bool = False, group_cols: list[str] | None = None,
                   suffix: str = "_cum", window_rows: int = WINDOW_ROWS, fan: int = FAN) -> DataFrame:
    """Adds ``<value>_cum`` = sum of ``value`` over rows of the same group whose
    ``order_col`` comes before or at the row's (ties: row order inside a range, so
    pass distinct order values for tie-free totals and ranges of bounded size)."""
    group_cols = group_cols or []
    b, levels = _ranges(df, order_col, descending, window_rows, fan)
    totals = b.groupBy(*group_cols, *levels).agg(*[F.sum(v).alias(v) for v in value_cols])
    offsets = range_offsets(totals, group_cols, levels, value_cols)
    x = F.col(order_col)
    w = Window.partitionBy(*group_cols, *levels).orderBy(x.desc() if descending else x.asc()) \
              .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    j = b.join(offsets, [*group_cols, *levels])  # AQE broadcasts it while it is small
    return j.select(*df.columns, *[(F.sum(v).over(w) + F.col(f"_o_{v}")).alias(f"{v}{suffix}") for v in value_cols])


def _null_safe(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    if not keys:
        return a.crossJoin(b)
    b = b.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    return a.join(b, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])).drop(*[f"_k_{k}" for k in keys])


def exact_quantiles(df: DataFrame, col: str, qs: list[float], group_cols: list[str] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation between closest ranks (the
    NumPy/pandas default), one row per (group, q) with ``value``."""
    group_cols = group_cols or []
    from .joins import write_table
    # FAN ranges of all values are counted first; only those that hold an asked rank are
    # looked into, so that whole columns aren't moved
    vals = write_table(df.select(*group_cols, F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull()), "quantile_values")
    bounds = vals.agg(F.percentile_approx("v", _fractions(FAN), 10000)).first()[0] or []
    ranged = vals.withColumn("_r", _place(F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<double>"), F.col("v"), False))
    counts = write_table(ranged.groupBy(*group_cols, "_r").agg(F.count(F.lit(1)).alias("_c")), "quantile_ranges")
    n = counts.groupBy(*group_cols).agg(F.sum("_c").alias("_n"))
    before = range_offsets(counts, group_cols, ["_r"], ["_c"], "_before")
    asked = _null_safe(_null_safe(counts, before, [*group_cols, "_r"]), n, group_cols)
    rank = (F.col("_n") - 1)
    inside = [(F.col("_before_c") <= f(rank * q)) & (f(rank * q) < F.col("_before_c") + F.col("_c")) for q in qs for f in (F.floor, F.ceil)]
    asked = write_table(asked.where(reduce(or_, inside)).select(*group_cols, "_r", "_before_c", "_n"), "quantile_asked")
    found = _null_safe(ranged, asked, [*group_cols, "_r"]).groupBy(*group_cols, "_r", "_before_c", "_n", "v").agg(F.count(F.lit(1)).alias("c"))
    cum = running_totals(write_table(found, "quantile_found"), "v", ["c"], group_cols=[*group_cols, "_r"])
    cum = cum.withColumn("c_cum", F.col("c_cum") + F.col("_before_c")).withColumn("_lt", F.col("c_cum") - F.col("c"))
    pos = [(F.col("_n") - 1) * q for q in qs]

    def hit(r: Column) -> Column:
        return (F.col("_lt") <= r) & (r < F.col("c_cum"))
    any_hit = None
    for p in pos:
        h = hit(F.floor(p)) | hit(F.ceil(p))
        any_hit = h if any_hit is None else any_hit | h
    picked = cum.where(any_hit)
    aggs = []
    for i, p in enumerate(pos):
        aggs += [F.max(F.when(hit(F.floor(p)), F.col("v"))).alias(f"lo{i}"),
                 F.max(F.when(hit(F.ceil(p)), F.col("v"))).alias(f"hi{i}"),
                 F.max((F.col("_n") - 1) * qs[i]).alias(f"pos{i}")]
    one = picked.groupBy(*group_cols).agg(*aggs)
    rows = []
    for i, q in enumerate(qs):
        p, lo, hi = F.col(f"pos{i}"), F.col(f"lo{i}"), F.col(f"hi{i}")
        val = F.when(F.floor(p) == F.ceil(p), lo).otherwise((F.ceil(p) - p) * lo + (p - F.floor(p)) * hi)
        rows.append(F.struct(F.lit(float(q)).alias("q"), val.alias("value")))
    return one.select(*group_cols, F.explode(F.array(*rows)).alias("r")).select(*group_cols, "r.q", "r.value")
