"""Flagship plan: base classifier, evidence verdict and expanded-evidence verdict side by side.

The base is the TF-IDF logistic regression fitted on the training split; the
two evidence pipelines retrieve labelled training documents with BM25 (raw
claim, and every synonym variant of it), turn the hits into a verdict and
merge it with the base prediction by the confidence rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.operators import models as ML
from claimlens.plans.catalog_evidence import EvidencePlan
from claimlens.plans.catalog_models import logreg_model


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = EvidencePlan(spark, sf_dir)
    base = ML.predict(logreg_model(spark, sf_dir), plan.claims, ["doc_id"]).select(
        "doc_id", F.col("pred").alias("base_label"), F.col("confidence").alias("base_confidence"))
    w = plan.three_pipelines(base)
    return w.select("doc_id", "gold", "base_label", "base_confidence", "evidence_label", "evidence_verdict",
                    "evidence_confidence", "expanded_label", "expanded_verdict", "expanded_confidence")
