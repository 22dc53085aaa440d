"""Document fingerprints by I-Match over randomised lexicons; DataFrame functions only.

Terms are the distinct words of a text, lower-cased. The lexicon holds those in a band of inverse document frequency:
common terms say little, rarer ones come from errors and names, and the band bounds the lexicon by
2^RAREST * (mean number of terms of a text), however many texts there are. A text's terms in the lexicon are sorted and
hashed, which is the first part of its fingerprint. LEXICONS further parts hash what randomised subsets of the lexicon
leave of the text: each is a chain of ever smaller subsets, half the size from one to the next, and a part is the hash
of the text's sorted terms in the smallest subset of the chain that holds any of them. So a part says as much about a
text of ten terms as about one of ten thousand, and survives edits that do not touch that subset. The likeness
of two fingerprints is the share of equal parts.

Texts move once, by their own key, to meet the beginning of the next document; terms meet the lexicon by a join, which
broadcasts it where its counted size is at most BROADCAST terms and shuffles beyond.

Cases: a null text is empty. A text none of whose terms is in the lexicon has a fingerprint of all its words in their
order, so texts without words are like each other and like no others. Ids may repeat or be null: documents follow by
(id, hash of id and text), null ids first, and equal rows are one document, each with the same result. A document
that is alone is its own next. An empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.rows import ROW_KEY, identified
from basketry.workspace import Workspace

COMMONEST = 4  # of the band, in bits: a term may be in at most 2^-COMMONEST of the documents
RAREST = 11  # and must be in at least 2^-RAREST of them
FEWEST = 2  # documents with a term of the lexicon
LEXICONS = 16
BROADCAST = 1 << 20  # terms
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PRIME = (1 << 31) - 1
ROOT = 48271  # a primitive root of PRIME: its powers tell the chains apart
PART = 8  # hex digits


def terms(text: Column) -> Column:
    """Distinct words of letters, digits and what lies beyond ASCII, lower-cased, in order of their first place."""
    return F.array_remove(F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS)), "")


def lexicon(texts: DataFrame, ws: Workspace, text: str = "text") -> tuple[DataFrame, int]:
    """(term, code) of the terms in the band, ``code`` being a number from 1 to 2^31 - 2; and how many there are."""
    n_texts = texts.select(F.count(F.lit(1)).alias("n")).first()["n"]
    frequency = texts.select(F.explode(terms(F.col(text))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    band = (F.col("df") * (1 << COMMONEST) <= n_texts) & (F.col("df") * (1 << RAREST) >= n_texts) & (F.col("df") >= FEWEST)
    code = F.conv(F.substring(F.md5("term"), 1, 15), 16, 10).cast("long") % (PRIME - 1) + 1
    saved, size = ws.save_measured(frequency.filter(band).select("term", code.alias("code")), "lexicon", terms=F.count(F.lit(1)))
    return saved, size["terms"]


def fingerprints(texts: DataFrame, keys: Sequence[str], known: tuple[DataFrame, int], keep: Sequence[str] = (), text: str = "text") -> DataFrame:
    """``keys``, ``fingerprint`` and the columns of ``keep``, for texts that ``keys`` tell apart."""
    table, size = known
    words = texts.select(*keys, *keep, terms(F.col(text)).alias("_words"))
    # A last element without a term carries what belongs to the text, so that a text without known terms stays.
    mark = F.struct(F.md5(F.array_join("_words", " ")).alias("whole"), *keep)
    none = F.when(F.lit(False), mark)
    elements = F.concat(
        F.transform("_words", lambda w: F.struct(w.alias("term"), none.alias("mark"))),
        F.array(F.struct(F.lit("").alias("term"), mark.alias("mark"))),
    )
    last = table.sparkSession.createDataFrame([("", None)], "term string, code long")
    table = table.unionByName(last)
    table = F.broadcast(table) if size <= BROADCAST else table
    found = words.select(*keys, F.inline(elements)).join(table, "term")
    whole = found.groupBy(*keys).agg(F.collect_list("code").alias("_codes"), F.max("mark").alias("_mark"))
    return whole.select(*keys, _fingerprint(F.col("_codes"), F.col("_mark")["whole"]).alias("fingerprint"), *[F.col("_mark")[c].alias(c) for c in keep])


def _fingerprint(codes: Column, whole: Column) -> Column:
    factors = F.array(*[F.lit(pow(ROOT, r + 1, PRIME)).cast("long") for r in range(LEXICONS)])
    value = lambda code, factor: code * factor % PRIME
    digest = lambda own, size: F.substring(F.md5(F.array_join(F.array_sort(own).cast("array<string>"), " ")), 1, size)
    # The smallest subset of a chain with a term: values below the power of two above the least value.
    below = F.transform(factors, lambda f: F.call_function(
        "shiftleft", F.lit(1).cast("long"), F.length(F.bin(F.array_min(F.transform(codes, lambda c: value(c, f)))))))
    limits = F.zip_with(factors, below, lambda f, b: F.struct(f.alias("f"), b.alias("b")))
    parts = F.transform(limits, lambda x: digest(F.filter(codes, lambda c: value(c, x["f"]) < x["b"]), PART))
    known = F.concat(F.array(digest(codes, 2 * PART)), parts)
    unknown = F.concat(F.array(F.substring(whole, 1, 2 * PART)), F.array_repeat(F.substring(whole, 1, PART), LEXICONS))
    return F.array_join(F.when(F.size(codes) > 0, known).otherwise(unknown), "-")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal parts of two fingerprints."""
    same = F.zip_with(F.split(a, "-"), F.split(b, "-"), lambda x, y: x == y)
    return F.size(F.filter(same, lambda x: x)) / F.size(same)


def following(keys: DataFrame, ws: Workspace) -> DataFrame:
    """(row_a, row_b, next_a, next_b, n_chars): each document's next one, the first after the last.

    ``keys`` (doc_id, row_a, row_b, n_chars) are dealt by range, numbered where they lie, and joined on numbers; what
    ties the stretches together is one row per task.
    """
    order = ["doc_id", *ROW_KEY]
    dealt = keys.distinct().repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ws.save(dealt.withColumn("at", F.monotonically_increasing_id()), "order")
    stretches = placed.groupBy(F.shiftright("at", 33).alias("stretch")).agg(F.min("at").alias("first"), F.max("at").alias("last"))
    every = Window.orderBy("stretch")
    start = F.coalesce(F.lead("first").over(every), F.min("first").over(Window.partitionBy()))
    stretches = ws.save(stretches.select("last", start.alias("start")), "stretches")
    numbered = placed.join(stretches, placed["at"] == stretches["last"], "left")
    numbered = numbered.select(*ROW_KEY, "n_chars", F.coalesce("start", F.col("at") + 1).alias("at"))
    return ws.save(numbered.join(placed.select("at", F.col("row_a").alias("next_a"), F.col("row_b").alias("next_b")), "at").drop("at"), "following")


def edited(docs: DataFrame, chain: DataFrame) -> DataFrame:
    """(row_a, row_b, next_a, next_b, n_chars, text, edited_text) of each distinct row of ``identified`` documents.

    The last quarter of the code points, rounded down, gives way to the first as many of the next document.
    """
    texts = docs.select(*ROW_KEY, F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(ROW_KEY)
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    wanted = chain.filter(quarter > 0).select(F.col("row_a").alias("to_a"), F.col("row_b").alias("to_b"), F.col("next_a").alias("row_a"), F.col("next_b").alias("row_b"), quarter.alias("quarter"))
    begins = texts.join(wanted, ROW_KEY).select(F.col("to_a").alias("row_a"), F.col("to_b").alias("row_b"), F.substring("text", F.lit(1), F.col("quarter")).alias("begin"))
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - quarter).cast("int"))
    return (
        texts.join(chain, ROW_KEY)
        .join(begins, ROW_KEY, "left")
        .select(*chain.columns, "text", F.concat(kept, F.coalesce("begin", F.lit(""))).alias("edited_text"))
    )


def edited_fingerprints(docs: DataFrame, ws: Workspace) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row."""
    docs = identified(docs)
    n_chars = F.length(F.coalesce("text", F.lit(""))).cast("long")
    keys = ws.save(docs.select("doc_id", *ROW_KEY, n_chars.alias("n_chars")), "keys")
    known = lexicon(docs, ws)
    both = edited(docs, following(keys, ws)).withColumn("edited_sha256", F.sha2("edited_text", 256))
    versions = F.array(
        F.struct(F.lit(0).alias("version"), F.col("text"), F.lit("").alias("edited_sha256")),
        F.struct(F.lit(1).alias("version"), F.col("edited_text").alias("text"), "edited_sha256"),
    )
    own = [*ROW_KEY, "next_a", "next_b"]
    found = fingerprints(both.select(*own, F.inline(versions)), [*own, "version"], known, ["edited_sha256"])
    of = lambda v: F.max(F.when(F.col("version") == v, F.col("fingerprint")))
    pairs = found.groupBy(*own).agg(F.max("edited_sha256").alias("edited_sha256"), of(0).alias("fingerprint"), of(1).alias("edited_fingerprint"))
    pairs = ws.save(pairs, "fingerprints")
    after = pairs.select(F.col("row_a").alias("next_a"), F.col("row_b").alias("next_b"), F.col("fingerprint").alias("_after"))
    results = pairs.join(after, ["next_a", "next_b"])
    near = likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("_after")).alias("near_next")
    return keys.join(results, ROW_KEY).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", *near)
