"""Input guard for claim texts: strip them, and mark or refuse empty ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.functions.text import BLANKS


def guard_texts(df: DataFrame, text_col: str = "text", strict: bool = False) -> DataFrame:
    """``text_col`` stripped of blanks at both ends, and ``status``: ``ok``, or ``empty`` for null and blank texts.

    ``strict`` counts the empty rows first and raises if there are any (one extra pass over the text column).
    """
    stripped = F.regexp_replace(text_col, f"^{BLANKS}|{BLANKS}$", "")
    out = df.withColumn("status", F.when(F.col(text_col).isNull() | (stripped == ""), F.lit("empty")).otherwise(F.lit("ok")))
    out = out.withColumn(text_col, stripped)
    if strict and (bad := out.where("status = 'empty'").count()):
        raise ValueError(f"{bad} of the claims have no text")
    return out
