r"""Personal data: base patterns, and terms that disclose them.

*Base.*  E-mail addresses, IP addresses, card numbers (12 to 19 digits, Luhn) and phone numbers are found by pattern in
the whole text.  The patterns are written so that the regex engine neither backtracks over a run again
nor recurses once per repetition, but match what the plain forms match.

*Information-theoretic sanitisation.*  Each base value is a protected entity.  The words around its places
(``CONTEXT_WORDS`` on either side) co-occur with it; over the whole corpus a term's disclosure is the share of the
documents with the term in which it stands next to the entity, that is 2 to the power of (pointwise mutual information
minus the entity's information content).  There is no least number of occurrences: a pair counts unless it can be an accident, that is
unless the entity's share of all documents, to the power of the pair's different contexts (copies of a text are one context), is more
than ``ACCIDENT``.  So a name seen once beside an address seen once counts, and words beside an address that most documents hold do
not.  A term that reaches ``GENERALISE`` is replaced by a placeholder in the documents that hold the entity; one that reaches
``REMOVE`` is removed.  The base spans stay as they are.

Everything is DataFrame functions.  Only words near entities form pairs, so a document makes at most
2 x ``CONTEXT_WORDS`` per value; word frequencies are counted before they shuffle; no text shuffles but those of
documents with a disclosed term (and words of texts, if so many rows are repeated that their list is not broadcast).

Defined results: null text is empty; doc_id and a hash of the text tell rows apart (rows that share an id, or null, may differ
in text; repeated rows give repeated rows); an empty table gives an empty table; other columns are kept by ``sanitise`` and ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import boxed, doc_key, text_key, unboxed, write_table
from claimlens.llm.quality_rules import let

KINDS = ("email", "ip", "card", "phone", "term")
CONTEXT_WORDS = 8
NEAR_CHARS = (400, 6400)  # looked at first for those words; the whole text if too few whole words stand there
ACCIDENT = 0.05
GENERALISE, REMOVE = 0.5, 0.9
MIN_TERM = 3

EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?>(?:\.[A-Za-z0-9-]++){1,100})+"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
CARD = r"[0-9][0-9\x01]{11,}"
CARD_SEPARATOR = r"(?<=[0-9])[\x20-](?=[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM_BREAK = r"[^\p{L}\p{N}]+"
_SPAN = "struct<start:int,ord:int,end:int,value:string>"


def spans(text: Column, pattern: Column, ord_: int, valid=None) -> Column:
    """Leftmost matches as sorted ``array<struct<start, ord, end, value>>`` in code points."""
    none = F.array().cast(f"array<{_SPAN}>")

    def placed(m: Column) -> Column:
        def walk(p: Column) -> Column:
            def step(acc: Column, i: Column) -> Column:
                a = acc["at"] + F.length(F.get(p, i))
                b = a + F.length(F.get(m, i))
                span = F.struct(a.alias("start"), F.lit(ord_).alias("ord"), b.alias("end"), F.get(m, i).alias("value"))
                return F.struct(b.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

            start = F.struct(F.lit(0).alias("at"), none.alias("out"))
            return F.aggregate(F.sequence(F.lit(0), F.size(m) - 1), start, step, lambda acc: acc["out"])

        return F.when(F.size(m) == 0, none).otherwise(let(F.split(text, pattern, -1), walk))

    found = let(F.regexp_extract_all(text, pattern, F.lit(0)), placed)
    return F.filter(found, lambda s: valid(s["value"])) if valid else found


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    def total(d: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            x = d.substr(-i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
            return acc + x - F.when(x > 9, 9).otherwise(0)

        n = F.length(d)
        return F.when((n >= 12) & (n <= 19), F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0).otherwise(F.lit(False))

    return let(_digits(value), total)


def base_spans(text: Column) -> Column:
    """All base spans of a text, sorted by start, then kind."""
    none = F.array().cast(f"array<{_SPAN}>")
    n_digits = lambda v: F.length(_digits(v))
    joined = F.regexp_replace(F.replace(text, F.lit("\x01"), F.lit("x")), CARD_SEPARATOR, "\x01")
    email = F.when(F.contains(text, F.lit("@")), spans(text, F.lit(EMAIL), 0)).otherwise(none)
    ip = F.when(text.rlike(r"[0-9]\.[0-9]"), spans(text, F.lit(IP), 1, lambda v: v.rlike(IP_PARTS))).otherwise(none)
    card = F.when(text.rlike(r"[0-9][\x20-]?[0-9]"), let(joined, lambda t: spans(t, F.lit(CARD), 2, _luhn))).otherwise(none)
    phone = F.when(text.rlike(r"\+[0-9]"), spans(text, F.lit(PHONE), 3, lambda v: (n_digits(v) >= 9) & (n_digits(v) <= 15))).otherwise(none)
    return F.array_sort(F.concat(email, ip, card, phone))


def terms(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return _long(F.split(F.lower(text), TERM_BREAK))


def _long(pieces: Column) -> Column:
    return F.filter(pieces, lambda w: F.length(w) >= MIN_TERM)


def _beside(text: Column, s: Column, left: bool, near: tuple = NEAR_CHARS) -> Column:
    """The ``CONTEXT_WORDS`` terms of the whole text that stand next before (or after) a span."""
    last = lambda x: F.slice(x, F.greatest(F.size(x) - CONTEXT_WORDS, F.lit(0)) + 1, F.lit(CONTEXT_WORDS))
    pick = last if left else lambda x: F.slice(x, 1, CONTEXT_WORDS)
    if not near:
        return pick(terms(text.substr(F.lit(1), s["start"]) if left else text.substr(s["end"] + 1, F.length(text))))
    chars = near[0]
    part = text.substr(F.greatest(s["start"] - chars, F.lit(0)) + 1, F.least(F.lit(chars), s["start"])) if left else text.substr(s["end"] + 1, F.lit(chars))

    def chosen(x: Column) -> Column:
        # the piece at the outer edge may be cut, unless the text ends there
        whole = F.slice(x["pieces"], 2, F.size(x["pieces"])) if left else F.slice(x["pieces"], 1, F.size(x["pieces"]) - 1)
        return let(_long(F.when(x["all"], x["pieces"]).otherwise(whole)), lambda w: F.when(
            x["all"] | (F.size(w) >= CONTEXT_WORDS), pick(w)).otherwise(_beside(text, s, left, near[1:])))

    return let(F.struct(F.split(F.lower(part), TERM_BREAK).alias("pieces"), (F.length(part) < chars).alias("all")), chosen)


def _contexts(text: Column, found: Column) -> Column:
    """Per span its entity (kind and normal value) and the words around it."""

    def around(s: Column) -> Column:
        words = F.concat(_beside(text, s, True), _beside(text, s, False))
        value = F.when(s["ord"] == 0, F.lower(s["value"])).when(s["ord"] == 1, s["value"]).otherwise(_digits(s["value"]))
        return F.struct(F.xxhash64(s["ord"], value).alias("entity"), words.alias("words"))

    return F.transform(found, around)


def find_base(docs: DataFrame) -> DataFrame:
    """``(doc_id, _key, _text, spans, contexts)`` for every row, written to the shared folder."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", doc_key().alias("_key"), text_key().alias("_text"), text.alias("text"))
    d = d.withColumn("spans", base_spans(F.col("text")))
    empty = F.array().cast("array<struct<entity:bigint,words:array<string>>>")
    d = d.withColumn("contexts", F.when(F.size("spans") > 0, _contexts(F.col("text"), F.col("spans"))).otherwise(empty))
    return write_table(d.select("doc_id", "_key", "_text", "spans", "contexts"), "pii")


def disclosures(docs: DataFrame, base: DataFrame, accident: float = ACCIDENT, generalise: float = GENERALISE) -> DataFrame:
    """``(entity, term, disclosure)`` for terms that reveal a protected entity, from the counts of the whole corpus."""
    near = base.where(F.size("contexts") > 0).select("_key", "_text", F.explode("contexts").alias("c")).select(
        "_key", "_text", "c.entity", F.xxhash64("c.words").alias("context"), F.explode(F.array_distinct("c.words")).alias("term"))
    pairs = near.groupBy("entity", "term").agg(F.count_distinct("context").alias("n_contexts"), F.count_distinct("_key", "_text").alias("n_both"))
    held = near.groupBy("entity").agg(F.count_distinct("_key", "_text").alias("n_entity"))
    total = base.select("_key", "_text").distinct().count()
    pairs = pairs.join(held, "entity").where(F.pow(F.col("n_entity") / total, "n_contexts") <= accident)
    # a repeated row counts once: n equal rows give n times each of their terms
    repeated = write_table(base.groupBy("_key", "_text").agg(F.count("*").alias("n")).where("n > 1"), "repeated")
    in_docs = docs.select(doc_key().alias("_key"), text_key().alias("_text"), F.array_distinct(terms(F.coalesce("text", F.lit("")))).alias("terms"))
    in_docs = in_docs.join(repeated, ["_key", "_text"], "left").select(F.coalesce("n", F.lit(1)).alias("n"), F.explode("terms").alias("term"))
    n_term = in_docs.groupBy("term", "n").agg(F.count("*").alias("m")).groupBy("term").agg(F.sum(F.expr("m div n")).alias("n_term"))
    return pairs.join(n_term, "term").withColumn("disclosure", F.col("n_both") / F.col("n_term")).where(
        F.col("disclosure") >= generalise).select("entity", "term", "disclosure")


def term_spans(docs: DataFrame, base: DataFrame, found: DataFrame) -> DataFrame:
    """``(_key, _text, term_spans)``: places of the terms that disclose an entity of the same document.

    ``value`` of a span is ``-`` if the term is removed, ``~`` if it is generalised.
    """
    held = base.where(F.size("contexts") > 0).select("_key", "_text", F.explode("contexts").alias("c")).select("_key", "_text", "c.entity").distinct()
    mine = held.join(found, "entity").groupBy("_key", "_text", "term").agg(F.max("disclosure").alias("d"))
    mine = mine.groupBy("_key", "_text").agg(F.collect_set(F.when(F.col("d") < REMOVE, F.col("term"))).alias("general"),
                                    F.collect_set(F.when(F.col("d") >= REMOVE, F.col("term"))).alias("gone"))
    text = docs.select(doc_key().alias("_key"), text_key().alias("_text"), F.coalesce("text", F.lit("")).alias("text"))
    text = text.join(mine, ["_key", "_text"]).dropDuplicates(["_key", "_text"])

    def places(terms_: str, mark: str) -> Column:
        pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(F.array_sort(terms_), "|"), F.lit(r")(?![\p{L}\p{N}])"))
        hits = F.when(F.size(terms_) > 0, spans(F.col("text"), pattern, 4)).otherwise(F.array().cast(f"array<{_SPAN}>"))
        return F.transform(hits, lambda s: F.struct(s["start"].alias("start"), s["ord"].alias("ord"), s["end"].alias("end"), F.lit(mark).alias("value")))

    return text.select("_key", "_text", F.concat(places("general", "~"), places("gone", "-")).alias("term_spans"))


def _joined(found: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["ord"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """``(doc_id, _key, _text, base, all)``: the base spans and all spans of every row, sorted."""
    base = find_base(docs)
    more = term_spans(docs, base, disclosures(docs, base))
    both = base.join(more, ["_key", "_text"], "left")
    return both.select("doc_id", "_key", "_text", F.col("spans").alias("base"), F.array_sort(F.concat(
        "spans", F.coalesce("term_spans", F.array().cast(f"array<{_SPAN}>")))).alias("all"))


def report(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term)`` for every row."""
    count = lambda k, of="base": F.size(F.filter(of, lambda s: s["ord"] == k)).cast("long")
    return find(docs).select(
        "doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])),
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"), count(4, "all").alias("n_term"))


def rewritten(text: Column, found: Column) -> Column:
    """The text with spans replaced by placeholders such as ``[EMAIL]``; overlapping spans become one."""
    labels = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def step(acc: Column, s: Column) -> Column:
        label = F.when((s["ord"] == 4) & (s["value"] == "-"), F.lit("")).otherwise(F.get(labels, s["ord"]))
        apart = s["start"] >= acc["at"]
        piece = F.when(apart, F.concat(text.substr(acc["at"] + 1, s["start"] - acc["at"]), label)).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], piece).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(found, start, step, lambda acc: F.concat(acc["out"], text.substr(acc["at"] + 1, F.length(text))))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in its text; ``n_chars`` follows if it is there."""
    hits = find(docs.select("doc_id", "text")).where(F.size("all") > 0).select("_key", "_text", "all").dropDuplicates(["_key", "_text"])
    d = boxed(docs, doc_key().alias("_key"), text_key().alias("_text"), F.col("text")).join(hits, ["_key", "_text"], "left")
    d = d.withColumn("text", F.when(F.size("all") > 0, rewritten(F.col("text"), F.col("all"))).otherwise(F.col("text")))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return unboxed(d, docs.columns, **changed)
