"""Scale rules checked on the physical plans of the registered queries."""

from claimlens.session import table_scope
from tests.conftest import SF001, SF01

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")

# queries without eager model fitting or materialisation while they are built
PLANNED = [
    "corpus_with_provenance", "corpus_union", "drop_null_text", "source_counts", "label_distribution",
    "label_collapse", "label_encode", "label_decode", "display_label", "headline_guard", "limit_rows",
    "stratified_split", "three_way_split", "balanced_sample", "seeded_shuffle", "heldout_only", "class_weights",
    "gold_pred_join", "accuracy", "classification_report", "macro_scores", "micro_weighted_scores",
    "confusion_matrix", "model_leaderboard", "chance_control",
    "combine_predictions", "override_transitions", "override_impact", "score_with_status", "epoch_loss",
    "early_stop", "softmax_scores", "argmax_label", "tokenize_words", "remove_stopwords", "word_bigrams",
    "top_vocabulary", "tfidf_weights", "sequence_encode", "normalise_token", "expandable_tokens",
    "token_synonyms", "expand_queries", "render_prompt", "parse_verdict",
]


def test_no_cartesian_or_row_udf(spark):
    import __spark_entry__ as e
    qs = e.queries()
    for name in PLANNED:
        plan = qs[name](spark, SF01)._jdf.queryExecution().executedPlan().toString()
        for bad in FORBIDDEN:
            assert bad not in plan, (name, bad)


# queries that write tables while they are built: planned on the smallest data
WRITING = [
    "evidence_topk", "evidence_topk_expanded", "prediction_report", "pipeline_overrides", "evidence_hook", "verdict_hook",
    "callable_score", "read_claims_tsv", "corpus_by_file_label", "eval_cases_read",
]
PARTS_OF_THESE = {"three_class_verdict", "binary_verdict", "three_pipeline_eval", "evidence_report", "pipeline_metrics", "case_model_grid",
                  "case_pass_rate", "case_result_lines"}


def test_no_cartesian_or_row_udf_in_queries_that_write(spark):
    import __spark_entry__ as e
    qs = e.queries()
    for name in WRITING:
        with table_scope(spark):
            plan = qs[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        for bad in FORBIDDEN:
            assert bad not in plan, (name, bad)


def test_no_query_is_left_out(spark):
    import __spark_entry__ as e
    models = {"train_logreg", "predict_labels", "predict_scores", "train_mlp", "batch_score", "model_dispatch", "model_roundtrip", "stream_score",
              "score_by_weights", "roundtrip_check", "stream_check"}  # fitted while they are built
    rest = {k for k in e.queries() if not k.startswith("op") and k != "pipeline"}
    assert rest == set(PLANNED) | set(WRITING) | PARTS_OF_THESE | models


def test_scans_prune_columns(spark):
    import __spark_entry__ as e
    plan = e.queries()["label_collapse"](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderpriority:string>" in plan
