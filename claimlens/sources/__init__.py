"""Readers and writers."""

from claimlens.sources.claims import (  # noqa: F401
    CLAIMS_TSV_SCHEMA, corpus_by_file_label, read_claim_splits, read_claims_tsv,
    read_eval_cases, require_columns, union_corpus,
)
from claimlens.sources.sinks import (  # noqa: F401
    pass_rate_lines, write_csv, write_lines,
)
from claimlens.sources.tables import read_table  # noqa: F401
