"""Column expressions: all run inside the JVM, none needs a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = str | Column


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(top: ColumnLike, bottom: ColumnLike) -> Column:
    """top / bottom, missing where the bottom is zero."""
    return _col(top) / F.nullif(_col(bottom), F.lit(0.0))


def relative_change(now: ColumnLike, before: ColumnLike) -> Column:
    return safe_ratio(_col(now) - _col(before), before)


def id_to_number(c: ColumnLike, prefix: str) -> Column:
    return F.replace(_col(c), F.lit(prefix), F.lit("")).cast("bigint")


def date_parts(date: ColumnLike) -> list[Column]:
    d = _col(date)
    return [
        F.year(d).alias("application_year"),
        F.month(d).alias("application_month"),
        F.day(d).alias("application_day"),
        F.weekday(d).alias("application_dayofweek"),
    ]


def quarter_bucket(date: ColumnLike) -> Column:
    d = _col(date)
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def finite(c: ColumnLike) -> Column:
    """Infinite and NaN values become missing."""
    x = _col(c).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def clipped_logit(p: ColumnLike, eps: float = 1e-6) -> Column:
    q = F.greatest(F.least(_col(p), F.lit(1 - eps)), F.lit(eps))
    return F.ln(q / (1 - q))


def above_threshold(p: ColumnLike, threshold: Column | float) -> Column:
    return (_col(p) >= threshold).cast("int")


def age_band(age: ColumnLike, bands: Sequence[tuple[str, int, int]]) -> Column:
    """Label of the left-closed band that holds the age; missing outside all bands."""
    out = None
    for label, low, high in bands:
        hit = (_col(age) >= low) & (_col(age) < high)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def small_cell(rows: ColumnLike, positives: ColumnLike) -> Column:
    few = (_col(rows) < 30) | (_col(positives) < 3)
    return F.when(few, "no, cell too small").otherwise("yes")


def bin_number(name: str, edges: Sequence[float], closed: str = "left") -> Column:
    """How many edges lie at or below the value (``left``) or strictly below it (``right``).

    Written as a balanced tree of comparisons, so the depth is the logarithm of the number
    of edges and the whole tree is compiled with the rest of the stage.
    """
    x, sign = f"CAST(`{name}` AS DOUBLE)", ">=" if closed == "left" else ">"
    cuts = sorted(edges)

    def tree(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        cut = f"CAST('{float(cuts[mid])!r}' AS DOUBLE)"
        return f"CASE WHEN {x} {sign} {cut} THEN {tree(mid + 1, hi)} ELSE {tree(lo, mid)} END"

    return F.expr(f"CASE WHEN {x} IS NOT NULL THEN {tree(0, len(cuts))} END")


def hash_number(*parts: ColumnLike | int) -> Column:
    """A number of 60 bits from the MD5 of the parts joined by ':'.

    It depends on the values alone, so a recomputed task draws the same numbers, and any
    SQL engine with MD5 can repeat it.
    """
    text = F.concat_ws(":", *[F.lit(str(p)) if isinstance(p, int) else _col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def is_odd_hash(*parts: ColumnLike | int) -> Column:
    return hash_number(*parts) % 2 == 1
