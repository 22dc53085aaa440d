"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once per document: its measurements and one long with a bit per failed rule are
kept. A policy is a named mask of rules, so applying, comparing or ablating policies needs the ledger
only: bits and counts, never the texts again.

Nothing moves between tasks: each text is measured in its own row. Repeated three-word windows are found
by sorting the text's windows, in n log n steps, so a long text has no quadratic cost.

Cases: null and empty texts have no words and fail ``few_words``; equal rows get equal results; null ids
are kept as they are; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 3
START_BITS = 20
START = (1 << START_BITS) - 1  # the largest start that a packed window holds


def let(value: Column, body) -> Column:
    """``body`` of the value, which is evaluated once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_list(text: Column) -> Column:
    """Words: runs of characters other than space and U+0009 to U+000D."""
    return F.array_remove(F.split(F.translate(text, SPACES[1:], " " * 5), " "), "")


def text_lines(text: Column) -> Column:
    """Lines with a word, as they are."""
    return F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")


def _covered(starts: Column) -> Column:
    """Words that windows with these sorted starts cover."""
    seen = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).cast("long").alias("last"))
    step = lambda a, at: F.struct((a["n"] + F.least(F.lit(WINDOW), at - a["last"])).alias("n"), at.alias("last"))
    return F.aggregate(starts, seen, step, lambda a: a["n"])


def packed_windows(words: Column) -> Column:
    """Sorted longs, one per window: upper bits of its hash, then its start. Null for texts of over a million words."""
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    upper = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]).bitwiseAND(F.lit(-START - 1))
    packed = F.sort_array(F.transform(starts, lambda i: upper(i).bitwiseOR(i.cast("long"))))
    return F.when(F.size(words) < WINDOW, F.array().cast("array<long>")).when(F.size(words) <= START, packed)


def hash_neighbours(packed: Column) -> Column:
    """(start, start of the window before in order) for windows with equal upper bits."""
    near = F.transform(packed, lambda x, i: F.when(
        (i > 0) & (F.shiftright(x.bitwiseXOR(F.get(packed, i - 1)), START_BITS) == 0),
        F.struct(x.bitwiseAND(F.lit(START)).alias("at"), F.get(packed, i - 1).bitwiseAND(F.lit(START)).alias("before")),
    ))
    return F.array_compact(near)


def repeated_words(words: Column, neighbours: Column) -> Column:
    """Words inside windows of three words that the text has twice or more, first ones included.

    Windows with equal hashes are compared word by word. Where two differ, as in texts too long to
    pack, the windows themselves are sorted instead, so the count is exact in any case.
    """

    def same(x: Column) -> Column:
        equal = F.lit(True)
        for k in range(WINDOW):
            equal = equal & (F.get(words, (x["at"] + k).cast("int")) == F.get(words, (x["before"] + k).cast("int")))
        return equal

    def from_text() -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
        whole = F.transform(starts, lambda i: F.struct(F.concat_ws(" ", *[F.get(words, i + k) for k in range(WINDOW)]).alias("w"), i.cast("long").alias("at")))

        def repeated(s: Column) -> Column:
            place = lambda x, i: F.when((x["w"] == F.get(s, i - 1)["w"]) | (x["w"] == F.get(s, i + 1)["w"]), x["at"])
            return F.array_sort(F.array_compact(F.transform(s, place)))

        return _covered(let(F.array_sort(whole), repeated))

    both = F.flatten(F.transform(neighbours, lambda x: F.array(x["at"], x["before"])))
    return (
        F.when(F.size(neighbours) == 0, F.lit(0).cast("long"))
        .when(F.forall(neighbours, same), _covered(F.array_sort(F.array_distinct(both))))
        .otherwise(from_text())
    )


CARRIED = "_row"


def measured(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id and the measurements that rules use; with ``carry`` the whole row as a struct, too."""
    text = F.coalesce(F.col("text"), F.lit(""))
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(CARRIED)] if carry else []
    rows = docs.select(*row, F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), word_list(text).alias("words"), text_lines(text).alias("lines"))
    rows = rows.withColumn("packed", packed_windows(F.col("words")))
    rows = rows.withColumn("neighbours", hash_neighbours(F.col("packed")))
    return rows.select(
        *([CARRIED] if carry else []),
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words"), F.col("neighbours")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
    )


@dataclass(frozen=True)
class Rule:
    """A name and the condition, over measurements, that fails a document."""

    name: str
    fails: str


#: Bit i of the ledger belongs to rule i: rules are added at the end and never renumbered.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 10 * word_chars"),
    Rule("repeated_lines", "n_dup_lines >= 3 and 100 * n_dup_lines > 30 * n_lines"),
    Rule("capitals", "100 * n_capitals > 40 * word_chars"),
    Rule("word_length", "word_chars > 40 * n_words or 2 * word_chars < 3 * n_words"),
)
BASE = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    """A version and the rules it applies."""

    version: str
    rules: tuple[str, ...]

    def mask(self, rules: tuple[Rule, ...] = RULES) -> int:
        return sum(1 << i for i, r in enumerate(rules) if r.name in self.rules)


POLICIES = (Policy("base", BASE), Policy("v1", tuple(r.name for r in RULES)))


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measurements and ``failed``, a long with a bit per rule."""
    rows = measured(docs)
    bits = [F.when(F.expr(r.fails), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, r in enumerate(rules)]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return rows.withColumn("failed", failed)


def kept(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether a row of the ledger passes the policy."""
    return F.col("failed").bitwiseAND(F.lit(policy.mask(rules)).cast("long")) == 0


def ablation(rows: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone, and that are kept without it.

    One pass: counts per bit pattern, of which there are at most two to the number of rules.
    """
    mask = policy.mask(rules)
    patterns = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("failed")).agg(F.count(F.lit(1)).alias("docs"))
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, r in enumerate(rules) if mask >> i & 1]))
    cells = patterns.select("failed", "docs", each.alias("r")).select("failed", "docs", "r.rule", "r.bit")
    count = lambda condition: F.sum(F.when(condition, F.col("docs")).otherwise(0))
    return cells.groupBy("rule").agg(
        count(F.col("failed").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        count(F.col("failed") == F.col("bit")).alias("failed_alone"),
        count((F.col("failed") == 0) | (F.col("failed") == F.col("bit"))).alias("kept_without"),
    )
