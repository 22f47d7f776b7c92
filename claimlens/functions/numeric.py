"""Numeric helpers that give bit-identical results in any SQL engine.

Rounding and fixed-point text are built from IEEE multiply, floor and integer
arithmetic only, so the same value prints the same way in Spark and in an
external SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_int(*parts, pos: int = 1) -> Column:
    """Unsigned integer of 8 hex digits of md5(parts joined by ':') from ``pos``."""
    text = F.concat_ws(":", *[F.lit(p) if not isinstance(p, Column) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), pos, 8), 16, 10).cast("bigint")


def round6(x) -> Column:
    """floor(x * 1e6 + 0.5) / 1e6 as DOUBLE."""
    return (F.floor(_col(x).cast("double") * F.lit(1000000.0) + F.lit(0.5)) / F.lit(1000000.0)).cast("double")


def fixed(x, decimals: int) -> Column:
    """Non-negative ``x`` as text with ``decimals`` places, half rounded up."""
    scale = 10 ** decimals
    units = F.floor(_col(x).cast("double") * F.lit(float(scale)) + F.lit(0.5)).cast("bigint")
    whole = F.floor(units / F.lit(scale)).cast("bigint").cast("string")
    if decimals == 0:
        return whole
    frac = F.lpad((units % F.lit(scale)).cast("string"), decimals, "0")
    return F.concat(whole, F.lit("."), frac)


def percent_text(x, decimals: int = 1, null_text: str | None = None) -> Column:
    """``0.1234`` -> ``12.3%``; null -> ``null_text``."""
    txt = F.concat(fixed(_col(x) * F.lit(100.0), decimals), F.lit("%"))
    if null_text is None:
        return txt
    return F.when(_col(x).isNull(), F.lit(null_text)).otherwise(txt)


def softmax(logits) -> Column:
    """exp(x - max) / sum over an ARRAY<DOUBLE> column."""
    arr = _col(logits)
    m = F.array_max(arr)
    ex = F.transform(arr, lambda v: F.exp(v - m))
    total = F.aggregate(ex, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(ex, lambda v: v / total)


def argmax_index(scores) -> Column:
    """0-based index of the largest score; the first index wins ties."""
    arr = _col(scores)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")
