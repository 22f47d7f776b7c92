r"""Line-first quality rules.

Every line is judged on its own: navigation and markup (too many of ``#*$%&|<>``), shouting (exclamation
marks, capitals only), boilerplate phrases, one word over and over.  A line that does not end in a sentence mark (of any script; closing
quotes, brackets and blanks may follow it) fails unless the next lines of its paragraph carry it on to a line that does: hard-wrapped
prose is not judged line by line.  A mark inside a line, as in a host name, does not count.  An
empty line or a line that fails for another reason ends a paragraph.  Thai and Lao write no sentence marks, so lines with their
letters need none.  Lines that fail
are removed; a document that loses more than ``MAX_LOST`` percent of its words is rejected, as is one that
fails the base rules (too short, or too many words in repeated three-word windows).

Everything is DataFrame functions on one row at a time: nothing shuffles, so no key can be hot.

Defined results: null text has no words and is rejected; lines without a word are kept and cost nothing;
repeated rows get equal results; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import boxed, unboxed

MIN_WORDS = 50
MAX_REPEAT = 50    # percent of the words
MAX_LOST = 30      # percent of the words
MAX_MARKS = 20     # symbols, or exclamation marks, per 100 words of a line
MIN_LINE_WORDS = 3  # shorter lines need no sentence mark
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
BOILERPLATE = ("licensed under", "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "uses cookies",
               "enable javascript", "lorem ipsum", "click here", "read more", "sign in to", "sign up to", "subscribe to our",
               "skip to content", "back to top")  # in lower case
CLOSERS = " \t\x0b\x0c\r\"'`)]}*_»”’›」』】）］｝〉》\u00a0\u3000"
# Unicode's Sentence_Terminal characters, the ellipsis, the Greek question mark and the Tibetan shads
_ENDS = """21 2E 3F 37E 589 61D-61F 6D4 700-702 7F9 837 839 83D-83E 964-965 F0D-F12 104A-104B 1362 1367-1368 166E 1735-1736 17D4-17D5
1803 1809 1944-1945 1AA8-1AAB 1B4E-1B4F 1B5A-1B5B 1B5E-1B5F 1B7D-1B7F 1C3B-1C3C 1C7E-1C7F 2024 2026 203C-203D 2047-2049 2CF9-2CFB 2E2E
2E3C 2E53-2E54 3002 A4FF A60E-A60F A6F3 A6F7 A876-A877 A8CE-A8CF A92F A9C8-A9C9 AA5D-AA5F AAF0-AAF1 ABEB FE12 FE15-FE16 FE52 FE56-FE57
FF01 FF0E FF1F FF61 10A56-10A57 10F55-10F59 10F86-10F89 11047-11048 110BE-110C1 11141-11143 111C5-111C6 111CD 111DE-111DF 11238-11239
1123B-1123C 112A9 113D4-113D5 1144B-1144C 115C2-115C3 115C9-115D7 11641-11642 1173C-1173E 11944 11946 11A42-11A43 11A9B-11A9C
11C41-11C42 11EF7-11EF8 11F43-11F44 16A6E-16A6F 16AF5 16B37-16B38 16B44 16D6E-16D6F 16E98 1BC9F 1DA88"""
SENTENCE_MARK = "[" + "".join("-".join(rf"\x{{{c}}}" for c in part.split("-")) for part in _ENDS.split()) + "]"
UNMARKED_SCRIPTS = r"[\x{0E00}-\x{0EFF}]"  # Thai and Lao
CARRIED = r"(?:(?<=M)|(?!^)\G)U"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once, also where a nested lambda reads it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def _windows(w: Column) -> Column:
    """The 64-bit hash of every three-word window, from hashes of the words."""
    return let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.when(F.size(h) < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)))))


def _by_hash(h: Column) -> Column:
    """The windows' hashes and positions in order; nothing if all hashes differ, since no window repeats then."""
    return F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))).otherwise(
        F.array().cast("array<struct<h:bigint,at:int>>"))


def _repeated(w: Column, s: Column) -> Column:
    """Positions of the windows whose words also stand elsewhere, from ``_by_hash``: equal windows are neighbours."""

    def same(a: Column, b: Column) -> Column:
        return (a["h"] == b["h"]) & (
            F.array(*(F.get(w, a["at"] + k) for k in range(3))) == F.array(*(F.get(w, b["at"] + k) for k in range(3))))

    def hit(x: Column, j: Column) -> Column:
        return F.coalesce(same(x, F.get(s, j - 1)), F.lit(False)) | F.coalesce(same(x, F.get(s, j + 1)), F.lit(False))

    return F.sort_array(F.transform(F.filter(s, hit), lambda x: x["at"]))


def _covered(p: Column) -> Column:
    """Words in windows of three that start at the sorted positions ``p``."""
    step = F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))).cast("long"))
    return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)


def _any_phrase(lower: Column) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(lower, F.lit(p)) for p in BOILERPLATE))


def _ends_sentence(line: Column) -> Column:
    last = F.substring(F.rtrim(line, F.lit(CLOSERS)), -1, 1)
    return last.isin(".", "!", "?") | last.rlike(SENTENCE_MARK) | ((F.length(line) < F.octet_length(line)) & line.rlike(UNMARKED_SCRIPTS))


def _judged(line: Column, symbols: Column, phrases: Column) -> Column:
    """A line with its number of words, whether it fails by itself, and whether it ends a sentence.

    ``symbols`` and ``phrases`` tell whether the text has any: the line is searched for them only then.
    """
    def count(x: str) -> Column:
        return F.length(line) - F.length(F.replace(line, F.lit(x), F.lit("")))

    def verdict(w: Column) -> Column:  # the line's words in lower case
        n = F.size(w)
        shout = F.contains(line, F.lit("!")) & (count("!") * 100 > n * MAX_MARKS)
        loud = (n >= 5) & ~line.rlike("[a-z]") & (F.upper(line) == line) & (F.lower(line) != line)
        marks = symbols & (F.regexp_count(line, F.lit(SYMBOL)) * 100 > n * MAX_MARKS)
        same = (n >= 10) & (F.size(F.array_distinct(w)) * 5 < n)
        fails = (n > 0) & (shout | marks | loud | same | (phrases & _any_phrase(F.lower(line))))
        return F.struct(line.alias("line"), n.cast("long").alias("n"), fails.alias("fails"), ((n > 0) & _ends_sentence(line)).alias("mark"))

    return let(words(F.lower(line)), verdict)


def _ended(lines: Column) -> Column:
    """One letter per line: E no word or failed, M sentence mark, C carried on to a line with one, U none of these."""
    letter = lambda x: F.when((x["n"] == 0) | x["fails"], "E").when(x["mark"], "M").otherwise("U")
    backwards = F.reverse(F.array_join(F.transform(lines, letter), ""))
    return F.split(F.reverse(F.regexp_replace(backwards, CARRIED, "C")), "")


def _flat(x: Column, letter: Column) -> Column:
    """``_judged`` of a line with its verdict once its paragraph is known."""
    return F.struct(x["line"].alias("line"), x["n"].alias("n"), (x["fails"] | ((x["n"] >= MIN_LINE_WORDS) & (letter == "U"))).alias("fails"))


def judge(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` plus one struct ``_q`` with the counts, the verdict and the cleaned text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    total = lambda a, of: F.aggregate(a, F.lit(0).cast("long"), of)
    lines = F.transform(F.split(text, "\n", -1), lambda x: _judged(x, F.col("_symbols") > 0, F.col("_phrases")))
    with_word = F.transform(F.filter("_lines", lambda x: x["n"] > 0), lambda x: x["line"])
    d = (docs.withColumn("_w", words(text)).withColumn("_symbols", F.regexp_count(text, F.lit(SYMBOL)).cast("long"))
         .withColumn("_phrases", _any_phrase(F.lower(text))).withColumn("_lines", lines).withColumn("_ends", _ended(F.col("_lines")))
         .withColumn("_lines", F.transform("_lines", lambda x, i: _flat(x, F.get("_ends", i))))
         .withColumn("_h", _windows(F.col("_w"))).withColumn("_s", _by_hash(F.col("_h")))
         .withColumn("_p", _repeated(F.col("_w"), F.col("_s")))
         .withColumn("_n", F.size("_w").cast("long"))
         .withColumn("_rep", _covered(F.col("_p")))
         .withColumn("_lost", total(F.col("_lines"), lambda a, x: a + F.when(x["fails"], x["n"]).otherwise(F.lit(0).cast("long")))))
    failed = (F.col("_n") < MIN_WORDS) | (100 * F.col("_rep") > MAX_REPEAT * F.col("_n"))
    kept_lines = F.transform(F.filter("_lines", lambda x: ~x["fails"]), lambda x: x["line"])
    return d.withColumn("_q", F.struct(
        F.col("_n").alias("n_words"), F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.col("_symbols").alias("n_symbols"),
        let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.col("_rep").alias("n_repeat_words"), failed.alias("base_failed"),
        (~failed & (100 * F.col("_lost") <= MAX_LOST * F.col("_n"))).alias("kept"),
        F.col("_lost").alias("n_words_removed"), F.array_join(kept_lines, "\n").alias("cleaned"),
    )).drop("_w", "_symbols", "_phrases", "_lines", "_ends", "_h", "_s", "_p", "_n", "_rep", "_lost")


def quality_report(docs: DataFrame) -> DataFrame:
    return judge(docs.select("doc_id", "text")).select("doc_id", *(f"_q.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_words_removed")))


def keep_clean(docs: DataFrame) -> DataFrame:
    """Rows that pass, their text without the failed lines; ``n_chars`` follows if it is there."""
    # generated once: a filter on it must not move below the counts and compute them again
    d = judge(boxed(docs, F.col("text"))).withColumn("_q", F.explode_outer(F.array("_q"))).where("_q.kept")
    changed = {"text": F.col("_q.cleaned")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(F.col("_q.cleaned")).cast(docs.schema["n_chars"].dataType)
    return unboxed(d, docs.columns, **changed)
