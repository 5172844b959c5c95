"""Straightforward versions of the operators, to compare with."""

from __future__ import annotations

import re

import xxhash


def fingerprint(text: str | None, width: int = 4) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes: list, linked) -> dict:
    """The smallest node that each node reaches over ``linked`` pairs."""
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    ordered = sorted(nodes)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if linked(a, b):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


def near_duplicates(rows: list[tuple], radius: int = 4) -> list[tuple]:
    """(key, fingerprint, smallest key reached) for rows of (key, text), keys not null."""
    prints = [(k, fingerprint(t)) for k, t in rows]
    reached = groups(sorted({p for _, p in prints}), lambda a, b: (a ^ b).bit_count() <= radius)
    least: dict = {}
    for k, p in prints:
        least[reached[p]] = min(k, least.get(reached[p], k))
    return sorted((k, f"{p:016x}", least[reached[p]]) for k, p in prints)


def base_spans(text: str | None) -> list[tuple]:
    """(start, place of the kind, kind, end) by the plain patterns."""
    text = text or ""

    def luhn(digits: str) -> bool:
        total = 0
        for i, c in enumerate(reversed(digits)):
            d = int(c) * (2 if i % 2 else 1)
            total += d - 9 if d > 9 else d
        return total % 10 == 0

    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    ]
    found = []
    for place, (kind, pattern, good) in enumerate(rules):
        found += [(m.start(), place, kind, m.end()) for m in re.finditer(pattern, text) if good(m.group())]
    return sorted(found)


def rule_counts(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w in windows if windows.count(w) > 1} if len(windows) < 2000 else _often(windows)
    hit = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(hit)


def _often(windows: list) -> set:
    seen, often = set(), set()
    for w in windows:
        (often if w in seen else seen).add(w)
    return often


def line_templates(line: str) -> list[tuple]:
    tokens = ["<*>" if re.search("[0-9]", t) else t for t in re.findall(r"[^ \t\x0B\f\r]+", line)]
    if not tokens:
        return []
    out, rest = [tuple(tokens)], len(tokens) - 2
    if len(tokens) >= 10:
        cuts = [2 + rest * i // 5 for i in range(6)]
        for i in range(5):
            out.append((i, *tokens[: cuts[i]], None, cuts[i + 1] - cuts[i], *tokens[cuts[i + 1] :]))
    return out


def without_recurring(docs: dict) -> dict:
    """Texts without lines whose template an earlier document has; wholly repeated ones go."""
    first: dict = {}
    for key in sorted(docs):
        for line in (docs[key] or "").split("\n"):
            for t in line_templates(line):
                first.setdefault(t, key)
    out = {}
    for key, text in docs.items():
        lines = (text or "").split("\n")
        kept = [x for x in lines if not any(first[t] < key for t in line_templates(x))]
        if len(kept) == len(lines):
            out[key] = text
        elif re.search(r"[^\s]", "\n".join(kept), re.ASCII):
            out[key] = "\n".join(kept)
    return out


def plain_words(text: str | None) -> list[str]:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contaminated(text: str | None, items: list, size: int = 10) -> bool:
    words = plain_words(text)
    for item in items:
        w = plain_words(item)
        n = min(len(w), size)
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        if any(tuple(words[i : i + n]) in grams for i in range(len(words) - n + 1)):
            return True
    return False
