"""Plain versions of the operators, row by row, to hold results against."""

from __future__ import annotations

import functools
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

_SPACES = re.compile(r"[\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def spaced(text: str | None) -> list[str]:
    return [w for w in _SPACES.split(text or "") if w]


def plain_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def repeats(rows: list[tuple]) -> list[tuple]:
    first: dict[tuple, int] = {}
    for doc, text in rows:
        w = spaced(text)
        for i in range(len(w) - 12):
            if doc is not None:
                key = tuple(w[i : i + 13])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        w = spaced(text)
        gone = set()
        for i in range(len(w) - 12):
            if doc is not None and first[tuple(w[i : i + 13])] < doc:
                gone.update(range(i, i + 13))
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def contamination(rows: list[tuple], items: list[tuple]) -> list[tuple]:
    windows = defaultdict(set)
    for item, text in items:
        w = plain_words(text)
        n = min(len(w), 10)
        for i in range(len(w) - n + 1) if w else ():
            windows[tuple(w[i : i + n])].add(str(item))
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in rows:
        w, hit, found = plain_words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i : i + n]))
                if own:
                    hit.update(range(i, i + n))
                    found |= own
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def shingles(text: str | None) -> frozenset:
    w = spaced(lower(text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def near(rows: list[tuple]) -> list[tuple]:
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both_known = rows[i][0] is not None and rows[j][0] is not None
            same = rows[i][0] == rows[j][0]
            if both_known and (same or (a and b and 100 * len(a & b) >= 75 * len(a | b))):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            r = find(i)
            least[r] = min(least.get(r, doc), doc)
    return [(d, len(s), None if d is None else least[find(i)], d is None or d == least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def exact(rows: list[tuple]) -> list[tuple]:
    groups = defaultdict(list)
    for doc, text in rows:
        groups[text or ""].append(doc)
    out = []
    for doc, text in rows:
        known = [d for d in groups[text or ""] if d is not None]
        keep = max(known) if known else None
        out.append((doc, keep, len(groups[text or ""]), doc == keep, sha(text or "")))
    return out


def held_out(doc) -> bool:
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def katz(rows: list[tuple], cutoffs: tuple[int, ...], discounts) -> list[tuple]:
    """Scores by the definition of the model, and a function for P(word | history)."""
    docs = [(d, [*spaced(lower(t or "")), "</s>"]) for d, t in rows]
    top = len(cutoffs)
    count = [Counter() for _ in range(top + 1)]
    for d, w in docs:
        if not held_out(d):
            p = ["<s>"] * (top - 1) + w
            for i in range(top - 1, len(p)):
                for n in range(1, top + 1):
                    count[n][tuple(p[i - n + 1 : i + 1])] += 1
    tokens, types = sum(count[1].values()), len(count[1])
    of = [None] + [discounts([sum(c == r for c in count[n].values()) for r in range(1, 7)], cutoffs[n - 1]) for n in range(1, top + 1)]
    follow = [defaultdict(list) for _ in range(top + 1)]
    context = [Counter() for _ in range(top + 1)]
    for n in range(2, top + 1):
        for g, c in count[n].items():
            context[n][g[:-1]] += c
            if c >= cutoffs[n - 1]:
                follow[n][g[:-1]].append(g[-1])

    def kept(n: int, c: int) -> float:
        return c * (of[n][c] if c <= 5 else 1.0) if c >= cutoffs[n - 1] else 0.0

    mass = sum(kept(1, c) for c in count[1].values())

    @functools.cache
    def history(h: tuple) -> tuple[float, float]:
        n = len(h) + 1
        seen = sum(kept(n, count[n][(*h, w)]) for w in follow[n][h]) / max(context[n][h], 1)
        lower_ = sum(p((*h[1:], w)) for w in follow[n][h])
        scale = context[n][h] / (context[n][h] + 1) if seen > 1 - 1e-9 else 1.0
        return scale, (1 - scale * seen) / (1 - lower_)

    def p(g: tuple) -> float:
        n = len(g)
        c = count[n][g]
        if n == 1:
            total, rest = (tokens, tokens - mass) if mass < tokens else (tokens + 1, 1)
            return kept(1, c) / total if c else rest / total
        scale, back = history(g[:-1])
        return scale * kept(n, c) / context[n][g[:-1]] if c >= cutoffs[n - 1] else back * p(g[1:])

    out = []
    for d, w in docs:
        s = ["<s>"] * (top - 1) + w
        score = sum(math.log10(p(tuple(s[i - top + 1 : i + 1]))) for i in range(top - 1, len(s)))
        base = sum(math.log10((count[1][(x,)] + 1) / (tokens + types + 1)) for x in w)
        out.append((d, held_out(d), len(w), sum(count[1][(x,)] > 0 for x in w), tokens, base, score))
    return out, p, [g[0] for g in count[1]], list(context[top])


def repetition(doc, text: str | None, limits) -> tuple:
    w, t = spaced(text), text or ""
    n = len(w)

    def repeated(k: int) -> int:
        windows = [tuple(w[i : i + k]) for i in range(n - k + 1)]
        often = Counter(windows)
        return len({p for i, x in enumerate(windows) if often[x] > 1 for p in range(i, i + k)})

    lines = [x for x in t.split("\n") if spaced(x)]
    n_repeat, n_covered = repeated(3), repeated(limits.least)
    longest = limits.least - 1
    if len(set(w)) == 1:
        longest = n - 1
    else:
        while repeated(longest + 1):
            longest += 1
    longest = longest if longest >= limits.least else 0
    failed = n < 50 or 100 * n_repeat > 50 * n
    kept = not failed and 100 * n_covered <= limits.percent * n and longest <= limits.longest
    symbols = sum(c in "#*$%&|<>" for c in t)
    return (doc, n, sum(map(len, w)), symbols, len(lines) - len(set(lines)), n_repeat, n_covered, longest, failed, kept)


def maximal_repeats(w: list[str], least: int) -> set[tuple]:
    """(words, occurrences, first word) of repeats that neither side extends everywhere."""
    out, n, size = set(), len(w), least
    while True:
        at = defaultdict(list)
        for i in range(n - size + 1):
            at[tuple(w[i : i + size])].append(i)
        several = [p for p in at.values() if len(p) > 1]
        if not several:
            return out
        for p in several:
            right = {w[i + size] if i + size < n else None for i in p}
            left = {w[i - 1] if i else None for i in p}
            if len(left) > 1 and len(right) > 1:
                out.add((size, len(p), p[0]))
        size += 1


def periodic_tail(doc, w: list[str]) -> list[str]:
    n = len(w)
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def periodic(doc, text: str | None) -> tuple:
    from fractions import Fraction

    w = spaced(text)
    n, found = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                found.setdefault((start, i + q), q)
            i += 1
    own = sorted((a, b - a, q) for (a, b), q in found.items())
    gone = {i for a, m, q in own for i in range(a + q, a + m)}
    best = min(own, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    strongest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{a},{m},{q}\n" for a, m, q in own)
    return (doc, len(own), *strongest, sha(lines), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def _linked(rows: list[tuple], a_path: str, b_path: str):
    """Per document its tokens' ends under both libraries, or None, and its links."""
    import json

    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a.encode_special_tokens = True
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
    with open(a_path, encoding="utf-8") as f:
        a_bytes = {i: bytes(byte[c] for c in t) for t, i in json.load(f)["model"]["vocab"].items() if all(c in byte for c in t)}

    def b_bytes(i: int) -> bytes:
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    out = []
    for doc, text in rows:
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        parts = [a_bytes[i] for i in ids[0]], [b_bytes(i) for i in ids[1]]
        whole = (" " + (text or "")).encode()
        if not text or any(b"".join(p) != whole for p in parts):
            out.append((doc, [], [], [], []))
            continue
        ends = [[sum(map(len, p[: i + 1])) for i in range(len(p))] if len(p) < 50 else _ends(p) for p in parts]
        i = j = start = 0
        links, groups = [], []
        group: tuple[list, list] = ([], [])
        fresh = [True, True]
        while i < len(ids[0]) and j < len(ids[1]):
            links.append((ids[0][i], ids[1][j]))
            for side, k in ((0, i), (1, j)):
                if fresh[side]:
                    group[side].append(ids[side][k])
            x, y = ends[0][i], ends[1][j]
            fresh = [x <= y, y <= x]
            i, j = i + (x <= y), j + (y <= x)
            if x == y:
                groups.append(group)
                group = ([], [])
        assert i == len(ids[0]) and j == len(ids[1]) and start == 0
        out.append((doc, *ids, links, groups))
    return out


def _ends(parts: list[bytes]) -> list[int]:
    out, at = [], 0
    for p in parts:
        at += len(p)
        out.append(at)
    return out


def pair_counts(rows: list[tuple], a_path: str, b_path: str) -> dict:
    docs, links = Counter(), Counter()
    for _, _, _, own, _ in _linked(rows, a_path, b_path):
        links.update(own)
        docs.update(set(own))
    return {p: (docs[p], links[p]) for p in links}


def aligned(rows: list[tuple], a_path: str, b_path: str) -> list[tuple]:
    linked = _linked(rows, a_path, b_path)
    count = Counter(x for r in linked for x in r[3])
    most: dict[int, int] = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for doc, a, b, links, groups in linked:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        best = sum(count[x] == most[x[1]] for x in links)
        out.append((doc, len(a), len(b), len(groups), len(links), sha(text) if a else "", best, sum(count[x] for x in links)))
    return out


def ordinal_fit(rows: list[set[int]], grades: list[int], features: list[int], penalty: float = 1.0) -> tuple[dict[int, float], list[float]]:
    """Weights and thresholds that maximise the penalised likelihood, by a pattern search over each number."""
    top = max(grades)

    def cuts(params):
        out = [params[len(features)]]
        for gap in params[len(features) + 1 :]:
            out.append(out[-1] + math.exp(gap))
        return out

    def loss(params):
        w, t = dict(zip(features, params)), cuts(params)
        total = penalty / 2 * sum(x * x for x in w.values())
        for row, grade in zip(rows, grades, strict=True):
            score = sum(w.get(f, 0.0) for f in row)
            above = [1.0, *(1 / (1 + math.exp(k - score)) for k in t), 0.0]
            total -= math.log(above[grade] - above[grade + 1])
        return total

    params = [0.0] * (len(features) + top)
    best, step = loss(params), 1.0
    while step > 1e-5:
        better = False
        for i in range(len(params)):
            for move in (step, -step):
                tried = [*params[:i], params[i] + move, *params[i + 1 :]]
                if (value := loss(tried)) < best - 1e-12:
                    params, best, better = tried, value, True
        step = step if better else step / 2
    return dict(zip(features, params)), cuts(params)
