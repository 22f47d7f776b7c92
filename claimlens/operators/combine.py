"""Merge a base prediction with an evidence verdict, and the report rows built on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.constants import BASE_LOW, BASE_MID, EVIDENCE_HIGH, LABELS
from claimlens.functions.labels import display_label
from claimlens.functions.numeric import percent_text


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def merge_rule(base_label, base_conf, ev_label, ev_conf) -> Column:
    """Number (1-7) of the first matching branch of the merge rule.

    1 evidence missing -> base; 2 evidence equals base -> base;
    3 base confidence missing and ev_conf >= 0.95 -> evidence; 7 base confidence missing otherwise -> base;
    4 base_conf < 0.50 and ev_conf >= 0.95 -> evidence;
    5 base_conf < 0.60, evidence mixed, ev_conf >= 0.95 -> mixed; 6 base.
    """
    bl, bc, el, ec = _col(base_label), _col(base_conf), _col(ev_label), _col(ev_conf)
    high = ec >= F.lit(EVIDENCE_HIGH)
    return (F.when(el.isNull(), F.lit(1))
            .when(el == bl, F.lit(2))
            .when(bc.isNull() & high, F.lit(3))
            .when(bc.isNull(), F.lit(7))
            .when((bc < F.lit(BASE_LOW)) & high, F.lit(4))
            .when((bc < F.lit(BASE_MID)) & (el == F.lit("mixed")) & high, F.lit(5))
            .otherwise(F.lit(6)))


def combine_predictions(base_label, base_conf, ev_label, ev_conf) -> Column:
    """Final label: evidence overrides only an uncertain base prediction."""
    bl, el = _col(base_label), _col(ev_label)
    rule = merge_rule(base_label, base_conf, ev_label, ev_conf)
    return (F.when(rule.isin(3, 4), el)
            .when(rule == 5, F.lit("mixed"))
            .otherwise(bl))


# Display strings for labels (ours); unknown labels fall through unchanged.
DISPLAY = {"true": "TRUE", "mixed": "MIXED", "false": "FALSE"}


def score_with_status(df: DataFrame, use_evidence: str = "use_evidence", available: str = "evidence_available",
                      base_label: str = "base_label", base_conf: str = "base_confidence",
                      ev_label: str = "evidence_label", ev_conf: str = "evidence_confidence") -> DataFrame:
    """Scoring flow with failure handling.

    ``status``: ``base_only`` (no evidence asked for), ``evidence_unavailable``
    (no evidence source), ``evidence_error`` (verdict outside the label set or
    confidence outside 0..1), else ``ok``.  Only ``ok`` rows merge.
    """
    ec = F.col(ev_conf)
    bad = (~F.col(ev_label).isin(LABELS)) | F.col(ev_label).isNull() | ec.isNull() | (ec < 0) | (ec > 1)
    status = (F.when(~F.col(use_evidence), F.lit("base_only"))
              .when(~F.col(available), F.lit("evidence_unavailable"))
              .when(bad, F.lit("evidence_error"))
              .otherwise(F.lit("ok")))
    final = F.when(status == "ok", combine_predictions(base_label, base_conf, ev_label, ev_conf)) \
        .otherwise(F.col(base_label))
    return df.withColumn("status", status).withColumn(
        "display_label", display_label(F.col(base_label), DISPLAY)).withColumn(
        "confidence_text", percent_text(F.col(base_conf), 1, "N/A")).withColumn("final_label", final)


def sources_text(sources) -> Column:
    """Bullet lines ``- source`` or ``None`` for an empty / missing list."""
    s = _col(sources)
    return F.when(s.isNull() | (F.size(s) == 0), F.lit("None")).otherwise(
        F.array_join(F.transform(s, lambda x: F.concat(F.lit("- "), x)), "\n"))
