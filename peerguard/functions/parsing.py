"""Column expressions for raw-file normalization (all JVM-side built-ins).

Every parse is total: ANSI mode raises on bad casts, so ``try_*`` forms are used
and a blank cell is treated as absent (never as the text "nan").
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column | str) -> Column:
    """Trimmed text, or NULL when the cell is missing or only whitespace."""
    c = F.col(c) if isinstance(c, str) else c
    t = F.trim(c)
    return F.when(t != "", t)


def parse_compact_date(c: Column | str) -> Column:
    """``YYYYMMDD`` (8+ chars, first 8 used) or ``YYYYMM`` (6-7 chars, day 01);
    anything else, including impossible dates, gives NULL."""
    t = F.trim(F.col(c) if isinstance(c, str) else c)
    n = F.length(t)
    return (F.when(n >= 8, F.try_to_date(F.substring(t, 1, 8), "yyyyMMdd"))
             .when(n >= 6, F.try_to_date(F.concat(F.substring(t, 1, 6), F.lit("01")), "yyyyMMdd")))


def collect_codes(columns: Iterable[str]) -> Column:
    """Non-blank codes of numbered columns, trimmed, in column order."""
    arr = F.array(*[F.trim(F.col(c)) for c in columns])
    return F.filter(arr, lambda x: x.isNotNull() & (x != ""))


def numbered(prefix: str, n: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(1, n + 1)]


def parse_amount(c: Column | str) -> Column:
    """Amount as double; blank, unparseable or NaN gives 0.0."""
    c = F.col(c) if isinstance(c, str) else c
    v = F.trim(c).try_cast("double")
    return F.coalesce(F.nanvl(v, F.lit(None).cast("double")), F.lit(0.0))


def truncating_int(c: Column | str) -> Column:
    """``int(float(text))``: '3.7' gives 3; bad text gives NULL."""
    c = F.col(c) if isinstance(c, str) else c
    d = F.nanvl(F.trim(c).try_cast("double"), F.lit(None).cast("double"))
    return F.when(F.abs(d) < 2147483648.0, d.cast("int"))


def length_of_stay(claim_type: Column, los_text: Column, start: Column, end: Column) -> Column:
    """Inpatient: the stated LOS truncated, else max(0, end - start) days, else 0.
    Other claim types: 0."""
    by_dates = F.when(start.isNotNull() & end.isNotNull(), F.greatest(F.lit(0), F.datediff(end, start)))
    return (F.when(claim_type == "inpatient", F.coalesce(truncating_int(los_text), by_dates, F.lit(0)))
             .otherwise(F.lit(0)))


def resolve_specialty(own: Column, mapped: Column, unknown: str = "Unknown") -> Column:
    """Own specialty, else the provider map value, else ``Unknown``."""
    return F.coalesce(blank_to_null(own), blank_to_null(mapped), F.lit(unknown))


def principal_diagnosis(codes: Column) -> Column:
    return F.coalesce(F.get(codes, 0), F.lit(""))


def birth_year(c: Column | str, default: int = 1940) -> Column:
    t = F.trim(F.col(c) if isinstance(c, str) else c)
    return F.coalesce(F.when(F.length(t) >= 4, F.substring(t, 1, 4).try_cast("int")), F.lit(default))


def chronic_conditions(flag_columns: Iterable[str], prefix: str = "SP_") -> Column:
    """Names (prefix removed) of the flag columns equal to '1', sorted."""
    items = [F.when(F.trim(F.col(c)) == "1", F.lit(c[len(prefix):])) for c in flag_columns]
    return F.array_sort(F.array_compact(F.array(*items)))
