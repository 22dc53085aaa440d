"""Plain Python versions of the operators' definitions, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lowered(text: str | None) -> str:
    return (text or "").translate(LOWER)


def contamination(docs: list[tuple], items: list[tuple], span: int = 10) -> list[tuple]:
    """(doc_id, n_words, n_hit, n_items, items_sha256) of each document."""
    windows = defaultdict(set)
    sizes = set()
    for item, text in items:
        words = ALNUM.findall(lowered(text))
        size = min(span, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows[tuple(words[i : i + size])].add(str(item))
            sizes.add(size)
    out = []
    for doc, text in docs:
        words = ALNUM.findall(lowered(text))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                own = windows.get(tuple(words[i : i + size]))
                if own:
                    hit.update(range(i, i + size))
                    found |= own
        out.append((doc, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return out


def shingles(text: str | None, n: int) -> frozenset:
    words = SPACED.findall(lowered(text))
    if not words:
        return frozenset()
    n = min(n, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def jaccard_components(docs: list[tuple], n: int, share: int) -> list[tuple]:
    """(doc_id, n_shingles, component_id): every pair with a common shingle is compared."""
    sets = [shingles(t, n) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    by = defaultdict(list)
    first: dict[frozenset, int] = {}
    for i, s in enumerate(sets):
        if not s:
            continue
        if s in first:
            parent[root(i)] = root(first[s])
            continue
        first[s] = i
        common = defaultdict(int)
        for x in s:
            for j in by[x]:
                common[j] += 1
            by[x].append(i)
        for j, c in common.items():
            if 100 * c >= share * (len(s) + len(sets[j]) - c):
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (doc, _) in enumerate(docs):
        least[root(i)] = min(doc, least.get(root(i), doc))
    return [(doc, len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(docs)]


def quality(docs: list[tuple]) -> list[tuple]:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    out = []
    for doc, text in docs:
        text = text or ""
        words = SPACED.findall(text)
        windows = defaultdict(list)
        for i in range(len(words) - 2):
            windows[tuple(words[i : i + 3])].append(i)
        hit = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
        lines = [x for x in text.split("\n") if SPACED.search(x)]
        out.append((doc, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)))
    return out


def _digest(kinds: list[str], found: list[tuple[int, int, int]]) -> tuple:
    text = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(found))
    return (*[sum(x[1] == k for x in found) for k in range(len(kinds))], hashlib.sha256(text.encode()).hexdigest())


def secrets(docs: list[tuple]) -> list[tuple]:
    """(doc_id, n_assign, n_access, n_hex, base_sha256), by the patterns as the contract writes them."""
    assign = re.compile(r"((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    out = []
    for doc, text in docs:
        text = text or ""
        found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
        out.append((doc, *_digest(["assign", "access", "hex"], found)))
    return out


def personal(docs: list[tuple]) -> list[tuple]:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256), by the patterns as the contract writes them."""

    def luhn(m: str) -> bool:
        digits = [int(c) for c in m if c.isdigit()]
        doubled = [d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0

    tests = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", luhn),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= sum(c.isdigit() for c in m) <= 15),
    ]
    out = []
    for doc, text in docs:
        found = [(m.start(), k, m.end()) for k, (p, ok) in enumerate(tests) for m in re.finditer(p, text or "") if ok(m[0])]
        out.append((doc, *_digest(["email", "ip", "card", "phone"], found)))
    return out


def line_dedup(docs: list[tuple], least: int = 50) -> dict[tuple, list[int]]:
    """(doc_id, text) → numbers of the lines that go, documents in order of id, each text once."""
    table = {}
    for doc, text in docs:
        lines = [(i, x, len(SPACED.findall(x))) for i, x in enumerate((text or "").split("\n"))]
        table[doc, text] = [x for x in lines if x[2]]
    runs = defaultdict(list)
    for key in table:
        own = table[key]
        for i in range(len(own)):
            words = 0
            for j in range(i, len(own)):
                words += own[j][2]
                if words >= least:
                    runs[tuple(x[1] for x in own[i : j + 1])].append((key, i, j))
                    if words - own[i][2] >= least:
                        break
    gone = {key: set() for key in table}
    for places in runs.values():
        if len(places) < 2:
            continue
        first, _, end = min(places, key=lambda p: (p[0][0], p[1]))
        for key, i, j in places:
            if key != first or i > end:
                gone[key].update(x[0] for x in table[key][i : j + 1])
    return {key: sorted(v) for key, v in gone.items()}
