"""Text scalar functions (tokens, n-grams, expansion predicates)."""

from __future__ import annotations

from functools import lru_cache
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.constants import EXPANSION_STOPWORDS, MIN_EXPANDABLE_LENGTH, TOKEN_PATTERN

# Characters with a digit value (decimal digits, super- and subscripts, circled and other single digits).
DIGIT_PATTERN = (r"[\p{Nd}\x{00B2}\x{00B3}\x{00B9}\x{1369}-\x{1371}\x{19DA}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}"
                 r"\x{2460}-\x{2468}\x{2474}-\x{247C}\x{2488}-\x{2490}\x{24EA}\x{24F5}-\x{24FD}\x{24FF}"
                 r"\x{2776}-\x{277E}\x{2780}-\x{2788}\x{278A}-\x{2792}\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}"
                 r"\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}]")
# Runs of blanks: ASCII white space, the separators 1C-1F, next line, and all Unicode separators.
BLANKS = r"[\s\x0B\x1C-\x1F\x85\p{Z}]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@lru_cache(maxsize=1)
def stopwords() -> tuple[str, ...]:
    """Spark's default English stop-word list (pyspark.ml StopWordsRemover)."""
    text = resources.files("claimlens.resources").joinpath("stopwords_english.txt").read_text("utf-8")
    return tuple(w for w in text.splitlines() if w)


def exploded(df: DataFrame, keep: list, array, name: str, pos: str | None = None) -> DataFrame:
    """``keep`` columns and one row per element of ``array``, named ``name`` (``pos``: its place); null elements are left out.

    ``explode`` lets the optimiser test the array's size in a filter of its own, which computes a derived array (tokens, n-grams) again
    for every test.  The outer form computes it once; its null rows go by the name.
    """
    out = F.posexplode_outer(_col(array)).alias(pos, name) if pos else F.explode_outer(_col(array)).alias(name)
    return df.select(*keep, out).where(F.col(name).isNotNull())


def word_tokens(text) -> Column:
    """Lower-case word tokens of two or more word characters."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(TOKEN_PATTERN), 0)


def remove_stopwords(tokens, words=None) -> Column:
    stop = F.array(*[F.lit(w) for w in (words or stopwords())])
    return F.filter(_col(tokens), lambda t: ~F.array_contains(stop, t))


def word_bigrams(tokens) -> Column:
    """Adjacent pairs joined by a space; empty for fewer than two tokens."""
    arr = _col(tokens)
    return F.when(F.size(arr) < 2, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(arr) - 1),
                    lambda i: F.concat(F.element_at(arr, i), F.lit(" "), F.element_at(arr, i + 1)))
    )


def whitespace_split(text) -> Column:
    """Split on runs of Unicode white space, dropping empty pieces."""
    return F.filter(F.split(_col(text), BLANKS), lambda t: t != "")


def normalise_token(token) -> Column:
    """Keep only ASCII letters and hyphens, lower-cased."""
    return F.lower(F.regexp_replace(_col(token), r"[^A-Za-z-]", ""))


def is_all_upper(token) -> Column:
    """Has a cased character and no lower-case one."""
    t = _col(token)
    return (t == F.upper(t)) & (t != F.lower(t))


def is_expandable(token, cleaned=None) -> Column:
    """Whether the token may be replaced.  ``cleaned``: its :func:`normalise_token`, if it is there already."""
    t = _col(token)
    cleaned = normalise_token(t) if cleaned is None else _col(cleaned)
    # a token that loses nothing when cleaned holds letters and hyphens alone: no digit is looked for there
    plain = F.length(t) == F.length(cleaned)
    return (
        (F.length(cleaned) >= MIN_EXPANDABLE_LENGTH)
        & ~cleaned.isin(EXPANSION_STOPWORDS)
        & (plain | ~t.rlike(DIGIT_PATTERN))
        & ~is_all_upper(t)
    )
