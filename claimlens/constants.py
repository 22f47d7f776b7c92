"""Fixed values.

FIXED VALUES -- these must equal the behaviour being reproduced for results to
be right.  They are stated plainly, in natural order, in one place.
"""

from __future__ import annotations

# Three-class label order; every tie-break and matrix order follows it.
LABELS = ["false", "mixed", "true"]

# Six fine-grained claim labels, in index order of the claims dataset.
FINE_LABELS = ["false", "half-true", "mostly-true", "true", "barely-true", "pants-fire"]

# Six fine labels collapsed to three classes.
FINE_TO_LABEL = {
    "true": "true",
    "mostly-true": "true",
    "half-true": "mixed",
    "barely-true": "mixed",
    "false": "false",
    "pants-fire": "false",
}

# Binary (real / fake) labels collapsed to three classes.
BINARY_TO_LABEL = {
    "real": "true",
    "fake": "false",
}

# Query expansion limits.
MAX_QUERIES = 3
MAX_REPLACEMENTS = 2
MAX_SYNONYMS = 2
THESAURUS_SENSES = 3
MIN_EXPANDABLE_LENGTH = 4

# Words never expanded.
EXPANSION_STOPWORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "have", "in",
    "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "were", "will", "with",
]

# Curated synonyms, looked up before the thesaurus.
CURATED_SYNONYMS = {
    "ban": ["prohibit"],
    "banned": ["prohibited"],
    "claim": ["assert"],
    "claims": ["asserts"],
    "drop": ["fall", "decline"],
    "dropped": ["fell", "declined"],
    "fake": ["false"],
    "help": ["assist"],
    "rise": ["increase"],
    "rose": ["increased"],
    "says": ["states"],
}

# Merge rule thresholds (strict < for the base, inclusive >= for evidence).
BASE_LOW = 0.50
BASE_MID = 0.60
EVIDENCE_HIGH = 0.95

# Split / sample defaults.
TEST_SIZE = 0.2
VALIDATION_SIZE = 0.25
SEED = 42
PER_LABEL = 10

# Vectoriser / classifier defaults.
MAX_FEATURES = 10000
REG_C = 1.0
MAX_ITER = 1000
EPOCHS = 5
PATIENCE = 2
BATCH_SIZE = 32

# Fixed-length encoding (BERT-style special ids).
MAX_LENGTH = 128
PAD_ID = 0
UNK_ID = 100
CLS_ID = 101
SEP_ID = 102

# Word-token pattern: two or more letters, digits or underscores.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
