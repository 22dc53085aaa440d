"""Secret scan: fixed patterns, and a battery of randomness tests with control of false discoveries.

The patterns give the base spans. Every other long token gets the smallest encoding that holds it, and
three tests against uniform randomness over that alphabet: chi-squared, runs about the middle of the
alphabet, and serial correlation of neighbours. A token that one of them rejects is no secret as a whole.
A token that no alphabet holds, or that a test rejects, is split at '=', then at the separators foreign to
each base64 alphabet, then at all separators, and its parts of ``LEAST_TOKEN`` characters are tested; of
overlapping ones the least like language stays. For the
rest the chance that a token of a language looks as even is taken from the noncentral chi-squared
law, which falls with length, and Benjamini and Hochberg's procedure picks the tokens per class of
length, over the whole corpus: chances are counted in bins, so the driver sees one bounded table. Tokens
of letters of one case, as language words are, are tested over their 26 letters in classes of their own.
Tokens of digits alone are not tested: most are numbers.

Cases: null and empty texts have no spans; equal rows get equal results; null ids are kept; an empty table
gives no rows; other columns are ignored. Time is linear in the text's length.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm import spans
from basketry.llm.rows import batch, plain
from basketry.workspace import Workspace

KINDS = ("assign", "access", "hex", "random")

# The base patterns.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6

LEAST_TOKEN = 16
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Ways to split a token: at inner '=', at what base64 and base64url do not have, at every separator.
PARTS = tuple(re.compile(p) for p in (r"[^=]+(?:=+$)?", r"[^=_-]+(?:=+$)?", r"[^=+/]+(?:=+$)?", r"[^=+/_-]+(?:=+$)?"))
LENGTHS = (24, 32, 48)  # bounds of the classes of length
REJECT = 0.001  # a random token is lost to each test this often
DISCOVERIES = 0.01  # expected share of false ones among tokens reported
BIN, BINS = 0.01, 2000  # of -log10 of the chance


@dataclass(frozen=True)
class Encoding:
    """An alphabet in code order, and the sum of squared letter shares of language text written in it."""

    name: str
    alphabet: str
    evenness: float


DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = (
    Encoding("hex", DIGITS + "abcdef", 0.14),
    Encoding("HEX", DIGITS + "ABCDEF", 0.14),
    Encoding("base32", UPPER + "234567", 0.068),
    Encoding("upper", DIGITS + UPPER, 0.068),
    Encoding("lower", DIGITS + LOWER, 0.068),
    Encoding("alnum", DIGITS + UPPER + LOWER, 0.06),
    Encoding("base64", UPPER + LOWER + DIGITS + "+/", 0.06),
    Encoding("base64url", UPPER + LOWER + DIGITS + "-_", 0.06),
)
CODES = [(e, {c: i for i, c in enumerate(e.alphabet)}) for e in ENCODINGS]
LETTERS = Encoding("letters", LOWER, 0.068)  # tokens without digits, of one case but for a leading capital


def normal_below(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def inferred(token: str) -> tuple[Encoding, list[int]] | None:
    """The first, smallest encoding that holds the token without its padding, and its codes."""
    body = token.rstrip("=")
    used = set(body)
    for encoding, codes in CODES:
        if used <= codes.keys():
            return encoding, [codes[c] for c in body]
    return None


def battery(encoding: Encoding, codes: list[int]) -> tuple[float, float, float, float]:
    """p of uniformity (chi-squared), of the number of runs, of serial correlation; chance of such evenness in language."""
    n, k = len(codes), len(encoding.alphabet)
    chi = sum(c * c for c in Counter(codes).values()) * k / n - n
    # Wilson and Hilferty's cube root makes chi-squared nearly normal.
    free = k - 1
    uniform = 1 - normal_below(((max(chi, 0.0) / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free)))
    x = np.array(codes, float)
    high = x >= k / 2
    ups = int(high.sum())
    if 0 < ups < n:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * ups * (n - ups) / n
        spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        by_runs = 2 * normal_below(-abs(runs - mean) / spread)
    else:
        by_runs = 2.0 ** (1 - n)
    centred = x - x.mean()
    total = float((centred**2).sum())
    serial = float((centred[1:] * centred[:-1]).sum()) / total if total else 1.0
    by_serial = 2 * normal_below(-abs(serial + 1 / n) * math.sqrt(n))
    shift = n * max(k * encoding.evenness - 1, 0.0)
    language = normal_below((chi - free - shift) / math.sqrt(2 * (free + 2 * shift)))
    return uniform, by_runs, by_serial, language


def base_spans(text: str) -> list[spans.Span]:
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def one_case(token: str) -> bool:
    return not any(c in DIGITS for c in token) and (token[1:].lower() == token[1:] or token.upper() == token)


def _tested(token: str) -> tuple[int, int] | None:
    """(class of length, bin) of a token or part that an alphabet holds and no test rejects."""
    if one_case(token):
        found = LETTERS, [LOWER.index(c) for c in token.lower() if c in LOWER]
    elif token.rstrip("=").isdigit() or (found := inferred(token)) is None:
        return None
    if len(found[1]) < LEAST_TOKEN:
        return None
    *tests, language = battery(*found)
    if min(tests) < REJECT:
        return None
    length = int(np.searchsorted(LENGTHS, len(found[1]), "right")) + (len(LENGTHS) + 1) * (found[0] is LETTERS)
    return length, min(BINS - 1, int(-math.log10(max(language, 1e-300)) / BIN))


def _in_token(token: str) -> list[tuple[int, int, int, int]]:
    """(start, end, class of length, bin) of the token if it passes, else of its parts that do."""
    if whole := _tested(token):
        return [(0, len(token), *whole)]
    parts = {m.span() for p in PARTS for m in p.finditer(token) if m.end() - m.start() >= LEAST_TOKEN} - {(0, len(token))}
    found = [(s, e, *passed) for s, e in parts if (passed := _tested(token[s:e]))]
    taken, out = spans.Disjoint(), []
    # A part of one case only stands where no other does: its bins are of other classes.
    for s, e, length, at in sorted(found, key=lambda x: (x[2] > len(LENGTHS), -x[3], x[0] - x[1], x[0])):
        if taken.take(s, e):
            out.append((s, e, length, at))
    return sorted(out)


def candidates(text: str, base: list[spans.Span]) -> Iterator[tuple[int, int, int, int]]:
    """(start, end, class of length, bin) of each token, or part of one, outside base spans that no test rejects."""
    covered = spans.Covered(base)
    for m in TOKEN.finditer(text):
        if not covered.overlaps(m.start(), m.end()):
            for start, end, length, at in _in_token(m[0]):
                yield m.start() + start, m.start() + end, length, at


def _scan() -> tuple[Callable, str]:
    fields = pa.schema([("doc_id", pa.int64()), ("base", spans.ARROW), ("tested", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("length", pa.int32()), ("bin", pa.int32())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, tested = [], []
            for text in plain(b.column(1)):
                text = text.as_py() or ""
                own = base_spans(text)
                base.append(spans.as_rows(own))
                tested.append([dict(zip(("start", "end", "length", "bin"), c, strict=True)) for c in candidates(text, own)])
            yield batch(fields, {"doc_id": b.column(0), "base": base, "tested": tested})

    return run, f"doc_id long, base {spans.SQL}, tested array<struct<start: int, end: int, length: int, bin: int>>"


def discovery_bins(scanned: DataFrame, share: float = DISCOVERIES) -> dict[int, int]:
    """Per class of length the least bin whose tokens are reported (Benjamini and Hochberg over all tokens of the class)."""
    counts = scanned.select(F.explode("tested").alias("t")).groupBy("t.length", "t.bin").count().collect()  # classes × bins
    least: dict[int, int] = {}
    for length in {r["length"] for r in counts}:
        bins = sorted(((r["bin"], r["count"]) for r in counts if r["length"] == length), reverse=True)
        total, upto = sum(c for _, c in bins), 0
        for at, c in bins:
            upto += c
            if 10 ** (-at * BIN) * total <= share * upto:
                least[length] = at
    return least


def secret_spans(docs: DataFrame, ws: Workspace) -> DataFrame:
    """(doc_id, base, spans) of each row: the base spans, and all with those that the battery adds."""
    run, schema = _scan()
    scanned = ws.save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema), "scanned")
    least = discovery_bins(scanned)

    def reported(t: Column) -> Column:
        out = F.lit(False)
        for length, at in least.items():
            out = out | ((t["length"] == length) & (t["bin"] >= at))
        return out

    random = F.transform(F.filter("tested", reported), lambda t: F.struct(t["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), t["end"].alias("end")))
    return scanned.select("doc_id", "base", F.array_sort(F.concat("base", random)).alias("spans"))
