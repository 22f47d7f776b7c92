"""Column functions: pure expressions, evaluated JVM-side inside codegen."""

from claimlens.functions.labels import (  # noqa: F401
    collapse_label, decode_label, display_label, encode_label,
)
from claimlens.functions.numeric import (  # noqa: F401
    argmax_index, fixed, hash_int, percent_text, round6, softmax,
)
from claimlens.functions.text import (  # noqa: F401
    is_all_upper, is_expandable, normalise_token, remove_stopwords, stopwords,
    whitespace_split, word_bigrams, word_tokens,
)
