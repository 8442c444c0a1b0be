"""Plain versions of the operators, for small tables."""

import math
import re
import zlib
from collections import Counter
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def statistics(text):
    w = words(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(n - 9 * (n > 9) for n in doubled) % 10 == 0


def spans(text):
    text, out = text or "", []
    out += [("email", m) for m in EMAIL.finditer(text)]
    out += [("ip", m) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m))
    out += [("phone", m) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return ",".join(f"{kind}:{m.start()}:{m.end()}" for kind, m in out)


def shingles(text):
    w = words(lowered(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def grouped(ids, pairs):
    """id -> smallest id reachable."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def near_duplicates(rows):
    sets = {i: shingles(t) for i, t in rows}
    pairs = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in grouped(sets, pairs).items()}


def lm_scores(rows, discount=0.75):
    tokens = [words(lowered(t)) + [" end"] for _, t in rows]
    single, pair = Counter(), Counter()
    for (i, _), w in zip(rows, tokens):
        if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2:
            single.update(w)
            pair.update(zip([" start", *w], w))
    total, kinds, after, different = sum(single.values()), len(single), Counter(), Counter()
    for (a, _), n in pair.items():
        after[a] += n
        different[a] += 1
    out = []
    for w in tokens:
        p1 = [(single[x] + 1) / (total + kinds + 1) for x in w]
        p2 = [p if not after[a] else (max(pair[a, b] - discount, 0) + discount * different[a] * p) / after[a] for a, b, p in zip([" start", *w], w, p1)]
        out.append((len(w), sum(single[x] > 0 for x in w), total, sum(map(math.log10, p1)), sum(map(math.log10, p2))))
    return out


STOCK = re.compile(
    r"(?i)\b(all rights reserved|terms of (use|service)|privacy policy|cookie|enable javascript|click here|sign (in|up)|log ?in|subscribe|read more"
    r"|share (this|on)|skip to content|lorem ipsum|licensed under|is licensed under|released under the)\b"
)


def line_fails(line):
    line = line.strip(" \t\n\x0b\x0c\r")
    n = len(words(line))
    if not n:
        return False
    symbols, bars = sum(c in "#*$%&|<>" for c in line), sum(c in "|»›·•¦" for c in line)
    doubled = (len(line) - len(line.replace("!!", "").replace("??", ""))) / 2
    fragment = n < 4 and line[-1] not in ".!?:;…\"'”»)"
    if symbols >= 0.5 * n or doubled >= 0.3 * n or fragment or (bars >= 2 and bars >= 0.2 * n):
        return True
    held = len(line) - len(STOCK.sub("", line))
    return held > 0 and held >= 0.15 * len(line)


def cleaned(text):
    """Whether the statistics fail, the text without failing lines, and whether it is kept."""
    n, _, _, _, repeated = statistics(text)
    failed = n < 10 or 100 * repeated > 20 * n
    lines = (text or "").split("\n")
    good = [line for line in lines if not line_fails(line)]
    all_, left = (sum(map(len, x)) for x in (lines, good))
    return failed, "\n".join(good), not failed and all_ - left <= 0.5 * all_


def differenced(sizes, shards):
    """Sorted sums of Karmarkar-Karp differencing, by sorting all partitions before every step."""
    partitions = [[0] * (shards - 1) + [size] for size in sizes]
    while len(partitions) > 1:
        partitions.sort(key=lambda p: p[-1] - p[0])
        a, b = partitions.pop(), partitions.pop()
        partitions.append(sorted(x + y for x, y in zip(a, reversed(b))))
    return partitions[0]
