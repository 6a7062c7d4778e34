"""Plain Python versions of what the operators compute, for small tables."""

import re
from collections import Counter, defaultdict

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SOLID = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingle_set(text, k=5):
    w = SOLID.findall(lower(text))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def near_components(docs, threshold=75):
    """id -> (set size, smallest id reachable)."""
    sets = {d: shingle_set(t) for d, t in docs}
    both = Counter()
    places = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            both.update((other, d) for other in places[x])
            places[x].append(d)
    groups = Sets()
    for (a, b), n in both.items():
        if 100 * n >= threshold * (len(sets[a]) + len(sets[b]) - n):
            groups.join(a, b)
    return {d: (len(s), groups.find(d)) for d, s in sets.items()}


def contaminated(docs, items, window=13):
    """id -> (words, hit words, item ids, contaminated)."""
    windows = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(lower(t))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k : k + n])].add(str(i))
    out = {}
    for d, t in docs:
        w = ALNUM.findall(lower(t))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out[d] = (len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w))
    return out


def repeated_lines(docs, min_chars=24, threshold=75):
    """{(id, line number)} of the lines that are not the first of their component."""
    places = defaultdict(list)
    for d, t in docs:
        for i, line in enumerate((t or "").split("\n") if t is not None else []):
            norm = line.strip(" ").lower()
            if len(norm) >= min_chars:
                places[norm].append((d, i))
    lines = list(places)
    grams = [{x[i : i + 5] for i in range(len(x) - 4)} for x in lines]
    groups = Sets()
    for i in range(len(lines)):
        groups.find(i)
        for j in range(i):
            n = len(grams[i] & grams[j])
            if 100 * n >= threshold * (len(grams[i]) + len(grams[j]) - n):
                groups.join(i, j)
    members = defaultdict(list)
    for i, x in enumerate(lines):
        members[groups.find(i)] += places[x]
    return {p for v in members.values() for p in sorted(v)[1:]}


def quality_counts(text):
    """(words, their characters, symbols, repeated lines, words in repeated 5-word windows)."""
    text = text or ""
    w = SOLID.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SOLID.search(line):
            dup += line in seen
            seen.add(line)
    times = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + j for i in range(len(w) - 4) if times[tuple(w[i : i + 5])] > 1 for j in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


PERSONAL = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def personal(text):
    """The base spans, kind:start:end in order."""
    found = []
    for place, (kind, pattern) in enumerate(PERSONAL):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(found)]
