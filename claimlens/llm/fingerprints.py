"""Document fingerprints by consistent weighted sampling.

A text is a bag of weighted terms: its words, each with weight ``count * length**2`` (frequent words are short, so
length stands in for rarity).  For every sample and term, two Gamma(2, 1) values r, c and a uniform b are derived from
hashes of the term alone; with weight S the term offers ``t = floor(ln S / r + b)`` at ``ln a = ln c - r (t - b + 1)``, and the
sample is the (term, t) with the smallest a.  Two texts agree in a sample with probability equal to their generalised Jaccard
similarity ``sum min(S) / sum max(S)``; the likeness of two fingerprints is the share of samples that agree.

Everything is DataFrame functions.  The order of the documents is decided on ids, text hashes and lengths alone.  Texts shuffle once, by id and text
hash; each text then sends its predecessor just the first code points that the edited text needs.  The words of a text are sorted and
counted inside its row, and its samples are minima over the exploded words that never leave the partition: neither words nor
counts shuffle.

Defined results: null text is empty; a text without words has one term, the text itself; rows of one id (or null) with different texts are documents of
their own, ordered by a hash of the text; repeated rows are one document and get equal results; "next" goes by those documents, null ids
first, and a single document follows itself; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import NULL_ID, doc_key, groups_for, text_key, write_table

SAMPLES = 32
BLANK = r"[\x20\x09-\x0D]+"
RANGE_ROWS = 1_000_000
DOC = ["_key", "_hash"]


def neighbours(docs: DataFrame) -> DataFrame:
    """``(_key, _hash, n, next_key, next_hash, before_key, before_hash, wanted)`` per document of ``docs(_key, _hash, n)``.

    ``wanted`` is the number of code points that the document before takes from this one.  Ids are dealt to ranges, whose number is
    written down with them; only the first and last row of each range meet in one task.
    """
    spark = docs.sparkSession
    docs = docs.distinct()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), groups_for(docs.count(), RANGE_ROWS))
    rows = write_table(docs.repartitionByRange(parts, *DOC).withColumn("_range", F.spark_partition_id()), "document-order")
    edges = rows.groupBy("_range").agg(F.min(F.struct(*DOC, "n")).alias("head"), F.max(F.struct(*DOC, "n")).alias("tail"))
    every = Window.orderBy("_range")  # one row per range
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = edges.select("_range", F.coalesce(F.lead("head").over(every), F.first("head").over(whole)).alias("_after"),
                         F.coalesce(F.lag("tail").over(every), F.last("tail").over(whole)).alias("_before"))
    order = Window.partitionBy("_range").orderBy(*DOC)
    me = F.struct(*DOC, "n")
    rows = rows.select("_range", *DOC, "n", F.lead(me).over(order).alias("_a"), F.lag(me).over(order).alias("_b")).join(edges, "_range")
    rows = rows.withColumn("_a", F.coalesce("_a", "_after")).withColumn("_b", F.coalesce("_b", "_before"))
    return rows.select(*DOC, "n", F.col("_a._key").alias("next_key"), F.col("_a._hash").alias("next_hash"), F.col("_b._key").alias("before_key"),
                       F.col("_b._hash").alias("before_hash"), F.floor(F.col("_b.n") / 4).cast("int").alias("wanted"))


def edited(text: Column, next_text: Column) -> Column:
    """The last quarter of the code points replaced by as many first ones of the next text."""
    part = F.floor(F.length(text) / 4).cast("int")
    return F.concat(text.substr(F.lit(1), F.length(text) - part), next_text.substr(F.lit(1), part))


def _samples(terms: DataFrame, keys: list[str]) -> DataFrame:
    """Per ``keys``: the sampled (term, t) hashes, eight hex digits per sample."""
    unit = lambda x, shift, bits: F.shiftrightunsigned(x, shift).bitwiseAND(F.lit((1 << bits) - 1)) + 0.5
    low = F.lit((1 << 32) - 1)

    def offer(i: int) -> Column:
        """ln a in the upper half of a long, the sample's hash in the lower half: the smallest long is the smallest a."""
        x, y = F.xxhash64("h", F.lit(i)), F.xxhash64("h", F.lit(SAMPLES + i))
        r = -F.log(unit(x, 0, 21) * unit(x, 21, 21) * 2.0 ** -42)  # the logarithms of two uniforms add up to Gamma(2, 1)
        c = -F.log(unit(y, 0, 32) * unit(y, 32, 32) * 2.0 ** -64)
        b = unit(x, 42, 22) * 2.0 ** -22
        t = F.floor(F.col("ln_s") / r + b)
        ln_a = F.log(c) - r * (t - b + 1)
        return F.shiftleft(((ln_a + 200) * (1 << 22)).cast("long"), 32).bitwiseOR(x.bitwiseXOR(t * 2654435761).bitwiseAND(low))

    # inside the aggregates the JVM gets one short method per sample
    least = terms.groupBy(*keys).agg(*(F.min(offer(i)).alias(f"m{i}") for i in range(SAMPLES)))
    text = F.concat(*(F.lpad(F.lower(F.hex(F.col(f"m{i}").bitwiseAND(low))), 8, "0") for i in range(SAMPLES)))
    return least.select(*keys, text.alias("fingerprint"))


def weighted_terms(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``(*keys, h, ln_s)`` from ``(*keys, text)``: the distinct words of each text, hashed, and the logarithm of their weights.

    The words are sorted inside the row; a word counts from its first place to the next word's.
    """
    words = F.filter(F.split("text", BLANK), lambda w: w != "")
    t = texts.select(*keys, F.sort_array(F.when(F.col("text").rlike(r"[^\x20\x09-\x0D]"), words).otherwise(F.array("text"))).alias("_s"))
    first = F.filter(F.sequence(F.lit(0), F.size("_s") - 1), lambda i: (i == 0) | (F.get("_s", i) != F.get("_s", i - 1)))
    t = t.select(*keys, "_s", first.alias("_p")).select(*keys, "_s", "_p", F.posexplode_outer("_p").alias("_j", "_i")).where("_i is not null")
    w = F.get("_s", F.col("_i"))
    count = F.coalesce(F.get("_p", F.col("_j") + 1), F.size("_s")) - F.col("_i")
    t = t.select(*keys, w.alias("w"), count.alias("c")).select(*keys, F.xxhash64("w").alias("h"), "c", F.greatest(F.length("w"), F.lit(1)).alias("n"))
    return t.select(*keys, "h", F.log(F.col("c").cast("double") * F.col("n") * F.col("n")).alias("ln_s"))


def likeness(a: Column, b: Column) -> Column:
    """Share of samples in which two fingerprints agree."""
    same = F.filter(F.sequence(F.lit(0), F.lit(SAMPLES - 1)), lambda i: a.substr(i * 8 + 1, F.lit(8)) == b.substr(i * 8 + 1, F.lit(8)))
    return F.size(same) / F.lit(float(SAMPLES))


def fingerprint(docs: DataFrame) -> DataFrame:
    """``(_key, _hash, fingerprint)`` of every document."""
    return _samples(weighted_terms(_texts(docs), DOC), DOC)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(doc_key().alias("_key"), text_key().alias("_hash"), F.coalesce("text", F.lit("")).alias("text"))


def with_edited(docs: DataFrame) -> DataFrame:
    """``(_key, _hash, next_key, next_hash, text, edited)`` per document."""
    texts = _texts(docs)
    order = neighbours(texts.select(*DOC, F.length("text").alias("n")))
    placed = texts.join(order, DOC)
    heads = placed.select(F.col("before_key").alias("_key"), F.col("before_hash").alias("_hash"),
                          F.col("text").substr(F.lit(1), F.col("wanted")).alias("head"))
    return placed.join(heads, DOC).select(*DOC, "next_key", "next_hash", "text", edited(F.col("text"), F.col("head")).alias("edited"))


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness (see the module's results)."""
    rows = with_edited(docs)
    info = [F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")]
    both = rows.select(*DOC, "next_key", "next_hash", *info, F.explode(F.array(
        F.struct(F.lit(0).alias("which"), "text"), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))).alias("x"))
    keys = [*DOC, "next_key", "next_hash", "n_chars", "edited_sha256", "which"]
    prints = _samples(weighted_terms(both.select(*keys[:-1], "x.which", "x.text"), keys), keys)
    prints = write_table(prints.groupBy(*keys[:-1]).agg(F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("fingerprint"),
                                                        F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("edited_fingerprint")),
                         "fingerprints")
    after = prints.select(F.col("_key").alias("next_key"), F.col("_hash").alias("next_hash"), F.col("fingerprint").alias("_next"))
    one = prints.join(after, ["next_key", "next_hash"]).select(
        *DOC, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"))
    id_type = docs.schema["doc_id"].dataType
    return docs.select(doc_key().alias("_key"), text_key().alias("_hash")).join(one, DOC).select(
        F.when(F.col("_key") != NULL_ID, F.col("_key")).cast(id_type).alias("doc_id"), *one.columns[2:])
