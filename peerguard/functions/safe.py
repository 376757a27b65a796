"""Total coercions used at the serving boundary (never raise under ANSI)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_float(c: Column | str, default: float = 0.0) -> Column:
    """Double, or ``default`` when missing, unparseable or NaN."""
    v = _c(c).try_cast("double")
    return F.coalesce(F.nanvl(v, F.lit(None).cast("double")), F.lit(float(default)))


def safe_int(c: Column | str, default: int = 0) -> Column:
    """Truncating int via double ('3.7' gives 3), or ``default``."""
    d = F.nanvl(_c(c).try_cast("double"), F.lit(None).cast("double"))
    return F.coalesce(F.when(F.abs(d) < 2147483648.0, d.cast("int")), F.lit(int(default)))


def list_json(c: Column | str) -> Column:
    """JSON text of a string list; NULL gives ``[]``."""
    return F.to_json(F.coalesce(_c(c), F.array().cast("array<string>")))


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(_c(c).cast("string"), F.lit(""))


def safe_date(c: Column | str) -> Column:
    """A date, the date of a timestamp, or ``YYYY-MM-DD`` text (one or two
    digits for month and day) as a date; NULL for other text."""
    text = _c(c).cast("string")
    stamp = F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2}) \d{2}:\d{2}:\d{2}(\.\d+)?$", 1)
    return F.try_to_date(F.when(stamp != "", stamp).otherwise(text), "yyyy-M-d")
