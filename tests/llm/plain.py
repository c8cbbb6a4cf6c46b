"""Plain versions of the operators, one text at a time, to compare with on small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None, size: int) -> set[tuple]:
    w = words((text or "").translate(LOWER))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def components(sets: dict, percent: int = 80) -> dict:
    """Smallest reachable id of each id, over links between all pairs."""
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def repeat_words(text: str | None, size: int = 5) -> int:
    w = words(text)
    runs = [tuple(w[i:i + size]) for i in range(len(w) - size + 1)]
    seen = Counter(runs)
    covered = set()
    for i, run in enumerate(runs):
        if seen[run] > 1:
            covered.update(range(i, i + size))
    return len(covered)


def base_counts(text: str | None) -> tuple:
    t = text or ""
    lines = [x for x in t.split("\n") if words(x)]
    n = len(words(t))
    repeated = repeat_words(t)
    return (n, sum(map(len, words(t))), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), repeated,
            n < 10 or 100 * repeated > 20 * n)


ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
                    r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text: str | None) -> list[tuple]:
    t = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def entropy(text: str) -> float:
    n = Counter(text)
    return -sum(c / len(text) * math.log2(c / len(text)) for c in n.values())


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def remainder(id, by: int) -> int:
    return zlib.crc32(str(id).encode()) % by


def partial_matching(train: list[bytes], order: int) -> "callable":
    """The method-C model with exclusion over all contexts, by nested dictionaries."""
    tables = [defaultdict(Counter) for _ in range(order + 1)]
    for text in train:
        stream = b"\xfe" * order + text + b"\xff"
        for i in range(order, len(stream)):
            for k in range(order + 1):
                tables[k][stream[i - k:i]][stream[i]] += 1

    def score(text: bytes) -> float:
        stream, total = b"\xfe" * order + text + b"\xff", 0.0
        for i in range(order, len(stream)):
            gone: set = set()
            for k in range(order, -1, -1):
                seen = tables[k].get(stream[i - k:i])
                if not seen:
                    continue
                left = {s: c for s, c in seen.items() if s not in gone}
                if stream[i] in left:
                    total += math.log10(left[stream[i]] / (sum(left.values()) + len(left)))
                    break
                if left:
                    total += math.log10(len(left) / (sum(left.values()) + len(left)))
                gone |= set(seen)
            else:
                total -= math.log10(255 - len(gone))
        return total

    return score


PHRASES = re.compile(r"(?i)(?<![^\W\d_])(?:cookie (policy|settings)|privacy policy|terms (of (use|service)|and conditions)|"
                     r"enable javascript|click here|read more|sign (in|up)|log ?in|subscribe (now|to)|"
                     r"skip to (main )?content|share (this|on)|lorem ipsum)(?![^\W\d_])")


def clean(text: str | None) -> tuple[str, bool]:
    """The lines that pass the rules, and whether the document stays."""
    def fails(line: str) -> bool:
        solid = sum(map(len, words(line)))
        spaces = len(line) - solid
        bars = sum(line.count(c) for c in "|»›•")
        return solid > 0 and (100 * len(re.findall(r"[#*$%&|<>!]", line)) > 10 * solid
                              or bars >= 3 and 4 * bars >= spaces + 1
                              or spaces + 1 <= 25 and bool(PHRASES.search(line)))

    kept = "\n".join(x for x in (text or "").split("\n") if not fails(x))
    n, chars, *_, failed = base_counts(text)
    return kept, not failed and 100 * sum(map(len, words(kept))) >= 50 * chars
