"""Label encode / decode / collapse / display as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimlens.constants import LABELS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_label(index, names=LABELS) -> Column:
    """Class index -> name; out of range gives the index as a string."""
    idx = _col(index)
    arr = F.array(*[F.lit(n) for n in names])
    in_range = (idx >= 0) & (idx < len(names))
    return F.when(idx.isNull(), F.lit(None).cast("string")).when(
        in_range, F.element_at(arr, (idx + 1).cast("int"))
    ).otherwise(idx.cast("string"))


def encode_label(label, names=LABELS) -> Column:
    """Class name -> 0-based index; unknown names give null."""
    pos = F.array_position(F.array(*[F.lit(n) for n in names]), _col(label))
    return F.when(pos > 0, (pos - 1).cast("int"))


def collapse_label(label, mapping: dict) -> Column:
    """Map a fine label to a coarse one; unmapped values become null (row kept)."""
    lab = _col(label)
    expr = None
    for src, dst in mapping.items():
        expr = F.when(lab == src, F.lit(dst)) if expr is None else expr.when(lab == src, F.lit(dst))
    return expr.otherwise(F.lit(None).cast("string"))


def display_label(label, mapping: dict) -> Column:
    """Display text for a label, falling through to the label itself."""
    lab = _col(label)
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[lab], lab)
