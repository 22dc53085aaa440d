"""Personal data: fixed patterns, and boosted trees over candidates of wider generators.

The patterns give the base spans. Generators of high recall propose more spans, which may overlap: number
groups, national phone formats, account numbers, spelled-out addresses. Each form has a check (``checked``):
a card's or account's check digits, an address that is a base one when written with @ and dots. Candidates
that it proves are added as they are. Gradient-boosted trees judge the others by their format and by the
words before them. They learn from the corpus itself: examples are base spans, base spans rewritten into
national, spelled-out and grouped forms that a generator takes, and proven candidates; counterexamples are
candidates that a check refutes (wrong check digits, dates, a byte over 255); those without proof either
way have no label. Neither checks nor the pattern's own kind are features. Each form has a threshold, set on
a held-out fold: the least score from which ``PRECISION`` of its labelled candidates and rewritten spans are
examples. A form without such a score adds proven candidates only, so that examples of one form never
outweigh the counterexamples of another. Among overlapping candidates proven ones come first, then the best score.

The trees learn from a bounded sample, an equal share of ``SAMPLE`` by hash for each form and label, so that no form
crowds out another; thresholds come from all of the held-out fold's rows, as counts per bin of scores. Every
candidate without proof is scored.

Cases: null and empty texts have no spans; equal rows get equal results; null ids are kept; without both
examples and counterexamples only proven candidates are added; undivided numbers that are no cards, and divided ones of
less than 9 or over 15 digits, have no examples and are not added, as nothing proves them; an empty table gives no rows; other columns are ignored.
Patterns are matched in linear time.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import spans
from basketry.llm.rows import ROW_KEY, batch, identified, plain
from basketry.workspace import Workspace

KINDS = ("email", "ip", "card", "phone", "other")
SAMPLE, PRECISION, SUPPORT, SEED = 20_000, 0.95, 20, 5
FOLDS, BINS = 5, 1000  # every fifth row is held out; bins of scores

# The base patterns. A digit run is entered at its first digit only, as a match that starts
# inside a run would have started before; an address is found from its @.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Wider generators.
GENERATORS = (
    re.compile(r"\(?[0-9]{2,4}\)?[\x20.-][0-9]{2,4}(?:[\x20.-][0-9]{2,5})+"),
    re.compile(r"(?<![0-9])[0-9]{9,19}(?![0-9])"),
    re.compile(r"(?<![0-9.])[0-9]{1,4}(?:\.[0-9]{1,4}){3}(?![0-9.])"),
    re.compile(r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Z0-9])"),
    re.compile(
        r"[A-Za-z0-9._%+-]{1,64}\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{2,63}"
        r"(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]{1,63}){0,8}"
    ),
    CARD,
)
CUES = {
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "card": ("card", "account", "iban", "karte", "konto", "carte", "compte", "tarjeta", "cuenta"),
    "person": ("name", "born", "ssn", "passport", "mail", "contact", "address", "adresse", "nombre"),
    "other": ("version", "isbn", "page", "figure", "chapter", "§", "no.", "nr."),
}
BEFORE, LONGEST = 40, 64
SPELLED_AT, SPELLED_DOT = re.compile(r"\x20?(?:\(at\)|\[at\])\x20?"), re.compile(r"\x20?(?:\(dot\)|\[dot\])\x20?")
ADDRESS = re.compile(rf"[A-Za-z0-9._%+-]+@{DOMAIN.pattern}")
FORMS = ("address", "account", "run", "card", "dotted", "phone", "number")
#: Digits per group of card numbers.
CARD_GROUPS = ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[spans.Span]:
    out: list[spans.Span] = []
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        after = DOMAIN.match(text, at + 1)
        if start < at and after:
            out.append((start, 0, after.end()))
            end = after.end()
        at = text.find("@", max(at + 1, end))
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(_byte(p) for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m[0]) if m.end() - m.start() <= 37 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return out


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def features(text: str, start: int, end: int) -> list[float]:
    """Format of the span and context before it; nothing that a base pattern validates."""
    body, before = text[start:end], text[max(0, start - BEFORE) : start].lower()
    digits = sum(c.isdigit() for c in body)
    groups = re.split(r"[^A-Za-z0-9]+", body.strip("()+ "))
    return [
        float(len(body)), float(digits), float(sum(c.isalpha() for c in body)), float(len(groups)),
        float(max(map(len, groups))), float(min(map(len, groups))), float(len(set(body))),
        *[float(body.count(c)) for c in (".", "-", " ", "(")],
        float(text[max(0, start - 1) : start].isalnum()), float(text[max(0, start - 1) : start] == "+"), float(text[end : end + 1].isalnum()),
        *[float(any(w in before for w in words)) for words in CUES.values()],
    ]


def _date(groups: list[str]) -> bool:
    """Begins with a calendar date, or has years only."""
    sizes, n = [len(g) for g in groups], [int(g) for g in groups]
    if len(n) > 1 and set(sizes) == {4}:
        return all(1000 <= x <= 2100 for x in n)
    if sorted(sizes[:3]) != [2, 2, 4] or sizes[1] == 4:
        return False
    year, *days = sorted(zip(sizes[:3], n, strict=False), reverse=True)
    return 1000 <= year[1] <= 2100 and all(1 <= d <= 31 for _, d in days) and min(d for _, d in days) <= 12


def mod97(account: str) -> bool:
    return len(account) >= 15 and int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def checked(text: str, start: int, end: int) -> tuple[int, int | None]:
    """The candidate's form, and 1 if the form's check holds, 0 if it fails, none if it does not decide."""
    body = text[start:end]
    if "@" in body or SPELLED_AT.search(body):
        return FORMS.index("address"), 1 if ADDRESS.fullmatch(SPELLED_DOT.sub(".", SPELLED_AT.sub("@", body))) else None
    if body[0].isalpha():
        return FORMS.index("account"), int(mod97(body.replace(" ", "")))
    groups = re.findall(r"[0-9]+", body)
    sizes, digits = tuple(map(len, groups)), "".join(groups)
    inside = text[max(0, start - 1) : start].isalnum() or text[end : end + 1].isalnum()
    if sizes in CARD_GROUPS or (len(sizes) == 1 and 12 <= sizes[0] <= 19):
        return FORMS.index("run" if len(sizes) == 1 else "card"), (None if inside else 1) if luhn(digits) else 0
    if len(sizes) == 4 and body.count(".") == 3:
        return FORMS.index("dotted"), None if all(_byte(g) for g in groups) else 0
    numbered = any(w in text[max(0, start - BEFORE // 2) : start].lower() for w in CUES["other"])
    form = "phone" if len(sizes) > 1 and 9 <= len(digits) <= 15 else "number"
    return FORMS.index(form), 0 if inside or numbered or _date(groups) or len(digits) > 19 else None


def _inner(text: str, match: re.Match[str]) -> Iterator[tuple[int, int]]:
    """Stretches of a number's groups that are grouped like a card, or like an account in front of other words."""
    if SPELLED_AT.search(match[0]):
        return
    if match[0][0].isalpha():
        yield from ((match.start(), match.start() + m.start()) for m in re.finditer(r"\x20", match[0]))
        return
    groups = [m.span() for m in re.finditer(r"[0-9]+", match[0])]
    sizes = tuple(e - s for s, e in groups)
    for sought in CARD_GROUPS:
        for i in range(len(sizes) - len(sought) + 1):
            if sizes[i : i + len(sought)] == sought:
                yield match.start() + groups[i][0], match.start() + groups[i + len(sought) - 1][1]


def _parts(match: re.Match[str]) -> Iterator[tuple[int, int]]:
    """Of a number that is too long for one item: words of 9 digits or more, and stretches of up to 5 other groups with 9 to 19 digits."""
    words = [(m.span(), sum(c.isdigit() for c in m[0]) >= 9) for m in re.finditer(r"[^\x20]+", match[0])]
    runs = [list(run) for _, run in itertools.groupby(enumerate(words), lambda x: x[0] if x[1][1] else -1)]
    for run in runs:
        low, high = run[0][1][0][0], run[-1][1][0][1]
        if run[0][1][1] and high - low <= LONGEST:
            yield match.start() + low, match.start() + high
            continue
        groups = [(low + m.start(), low + m.end()) for m in re.finditer(r"\(?[0-9]+", match[0][low:high])]
        for i in range(len(groups)):
            digits = 0
            for s, e in groups[i : i + 5]:
                digits += sum(c.isdigit() for c in match[0][s:e]) if e - s <= 20 else 20
                if digits > 19:
                    break
                if digits >= 9:
                    yield match.start() + groups[i][0], match.start() + e


def candidate_spans(text: str) -> set[tuple[int, int]]:
    out = set()
    for g in GENERATORS:
        for m in g.finditer(text):
            if m.end() - m.start() <= LONGEST or SPELLED_AT.search(m[0]):
                out.add(m.span())  # a spelled-out address is bounded by its pattern
            else:
                out.update(_parts(m))
            out.update(x for x in _inner(text, m) if checked(text, *x)[1])
    return {(s, e) for s, e in out if e - s >= 7}


def rewritten(body: str, kind: int) -> list[str]:
    """A base span in other forms that a generator takes as a whole."""
    forms: list[str] = []
    if KINDS[kind] == "email":
        local, domain = body.split("@", 1)
        forms = [f"{local} (at) {domain}", f"{local}[at]{domain}", f"{local} (at) {domain.replace('.', ' (dot) ')}"]
    elif KINDS[kind] == "card":
        digits = re.sub(r"[^0-9]", "", body)
        forms = [".".join(digits[i : i + 4] for i in range(0, 16, 4))] if len(digits) == 16 else []
    elif KINDS[kind] == "phone":
        groups = re.findall(r"[0-9]+", body)
        if len(groups) < 3:
            digits = "".join(groups)[-10:]
            groups = ["", digits[:3], digits[3:6], digits[6:]]
        first, *rest = groups[1:]
        forms = [f"({first}) {'-'.join(rest)}", *[c.join([first, *rest]) for c in "-. "], " ".join(["0" + first, *rest])]
    return [f for f in forms if (0, len(f)) in candidate_spans(f)]


def _scan() -> tuple[Callable, str]:
    """Per row its base spans; per candidate, base span and rewritten one a row with features and label."""
    fields = pa.schema(
        [("doc_id", pa.int64()), ("row_a", pa.int64()), ("row_b", pa.int64()), ("base", spans.ARROW)]
        + [("start", pa.int32()), ("end", pa.int32()), ("wider", pa.int32()), ("form", pa.int32()), ("example", pa.int32()), ("features", pa.list_(pa.float64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, rest = [], []
            for i, text in enumerate(plain(b.column(1))):
                text = text.as_py() or ""
                own = base_spans(text)
                found = [(spans.as_rows(own), None, None, None, None, None, None)]
                for s, k, e in own:
                    found.append((None, None, None, 0, checked(text, s, e)[0], 1, features(text, s, e)))
                    before, after = text[max(0, s - BEFORE) : s], text[e : e + 1]
                    for other in rewritten(text[s:e], k):
                        where = before + other + after, len(before), len(before) + len(other)
                        found.append((None, None, None, 1, checked(*where)[0], 1, features(*where)))
                covered = spans.Covered(own)
                for s, e in candidate_spans(text):
                    if not covered.overlaps(s, e):
                        found.append((None, s, e, 1, *checked(text, s, e), features(text, s, e)))
                ids += [i] * len(found)
                rest += found
            if ids:
                keys = [plain(b.column(c)).take(pa.array(ids)) for c in (0, 2, 3)]
                yield batch(fields, dict(zip(fields.names, [*keys, *map(list, zip(*rest, strict=True))], strict=True)))

    return run, f"doc_id long, row_a long, row_b long, base {spans.SQL}, start int, end int, wider int, form int, example int, features array<double>"


def added_spans(found: DataFrame, ws: Workspace) -> DataFrame:
    """(row key, start, end, score) of candidates that are proven (score 1) or that the trees accept."""
    found = found.filter("features is not null")  # told before the vectors are made: a base row has none
    candidates = found.filter("start is not null")
    sure = candidates.filter("example = 1").select(*ROW_KEY, "start", "end", F.lit(1.0).alias("score")).distinct()
    labelled = found.filter("example is not null").withColumn("held", F.pmod(F.xxhash64(*ROW_KEY, F.lit(SEED)), F.lit(FOLDS)) == 0)
    learned = ws.save(sampled(labelled.filter("not held")), "candidate-sample")
    if learned.select("example").distinct().count() < 2:
        return sure
    learned = learned.select(F.col("example").cast("double").alias("label"), array_to_vector("features").alias("features"))
    model = GBTClassifier(maxIter=20, maxDepth=3, seed=SEED).fit(learned)
    score = F.get(vector_to_array("probability"), F.lit(1))
    judged = lambda df: model.transform(df.withColumn("features", array_to_vector("features"))).withColumn("score", score).withColumn("bin", F.floor(F.col("score") * BINS))
    held = judged(labelled.filter("held and wider = 1").select("form", "example", "features"))
    bins = held.groupBy("form", "bin").agg(F.sum("example").alias("good"), F.count(F.lit(1)).alias("all")).collect()  # forms × bins
    accepted = F.lit(False)
    for form in range(len(FORMS)):
        least = calibrated([(r["bin"], r["good"], r["all"]) for r in bins if r["form"] == form])
        if least is not None:
            accepted = accepted | ((F.col("form") == form) & (F.col("bin") >= least))
    others = candidates.filter("example is null").select(  # what its own check refutes is never added
        *ROW_KEY, "start", "end", "form", "features")
    return sure.unionByName(judged(others).filter(accepted).select(*ROW_KEY, "start", "end", "score").distinct())


def sampled(labelled: DataFrame) -> DataFrame:
    """About ``SAMPLE`` rows, as many of each form and label; those with fewer are whole."""
    share = SAMPLE // (2 * len(FORMS))
    parts = 1 << 30
    kept = F.lit(False)
    at = F.pmod(F.xxhash64(*ROW_KEY, "features"), F.lit(parts))
    for r in labelled.groupBy("form", "example").count().collect():  # forms × labels
        kept = kept | ((F.col("form") == r["form"]) & (F.col("example") == r["example"]) & (at < parts * share // max(share, r["count"])))
    return labelled.filter(kept).select("form", "example", "features")


def calibrated(bins: list[tuple[int, int, int]]) -> int | None:
    """The least of (bin, examples, all) from which at least ``PRECISION`` of the candidates are examples, and ``SUPPORT`` are."""
    least, good, total = None, 0, 0
    for at, examples, count in sorted(bins, reverse=True):
        good += examples
        total += count
        if good >= PRECISION * total and good >= SUPPORT:
            least = at
    return least


@F.pandas_udf(spans.TYPE)
def _best(found: pd.Series) -> pd.Series:
    """Candidates of each row, best first and longer before shorter, each unless it overlaps an earlier one."""
    out = []
    for own in found:
        taken = spans.Disjoint()
        best = sorted(own, key=lambda x: (-x["score"], x["start"], -x["end"]))
        out.append(spans.as_rows((x["start"], KINDS.index("other"), x["end"]) for x in best if taken.take(x["start"], x["end"])))
    return pd.Series(out)


def personal_spans(docs: DataFrame, ws: Workspace) -> DataFrame:
    """(doc_id, base, spans) of each row: the base spans, and all with those that the trees add."""
    run, schema = _scan()
    found = ws.save(identified(docs).mapInArrow(run, schema), "candidates")
    added = ws.save(added_spans(found, ws), "accepted")
    # One row's accepted candidates are fewer than its characters.
    added = added.groupBy(*ROW_KEY).agg(_best(F.collect_list(F.struct("start", "end", "score"))).alias("more"))
    rows = found.filter("base is not null").select("doc_id", *ROW_KEY, "base").join(added, ROW_KEY, "left")
    return rows.select("doc_id", "base", F.array_sort(F.when(F.col("more").isNull(), F.col("base")).otherwise(F.concat("base", "more"))).alias("spans"))
