"""Plain Python versions of the contracts, for comparison on small tables."""

from __future__ import annotations

import hashlib
import math
import re
import struct
from collections import Counter, defaultdict

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def merged(n: int, starts: list[int], width: int) -> list[bool]:
    gone = [False] * n
    for s in starts:
        gone[s : s + width] = [True] * width
    return gone


def op5(docs: list[tuple[int, str | None]], width: int = 100) -> dict[int, tuple]:
    """docs in ascending doc_id."""
    seen, out = set(), {}
    for doc, text in docs:
        b = (text or "").encode()
        late = []
        for i in range(len(b) - width + 1):
            s = b[i : i + width]
            if s in seen:
                late.append(i)
            else:
                seen.add(s)
        gone = merged(len(b), late, width)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def op7(docs: list[tuple[int, str | None]], width: int = 4, percent: int = 85) -> dict[int, tuple]:
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for doc, text in docs:
        w = WORD.findall((text or "").translate(lower))
        sets[doc] = {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
    parent = {d: d for d in sets}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            holders[x].add(d)
    for d, s in sets.items():
        for e in {e for x in s for e in holders[x] if e < d}:
            both = len(s & sets[e])
            if 100 * both >= percent * len(s | sets[e]):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def op8(docs: list[tuple[int, str | None]]) -> dict[int, tuple]:
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(" \t\n\r\x0b\x0c").translate(lower)
    held = defaultdict(set)
    for doc, text in docs:
        for x in (text or "").split("\n"):
            held[key(x)].add(doc)
    out = {}
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 20 and len(held[key(x)]) >= 3 and doc < max(held[key(x)]))]
        out[doc] = (len(lines), len(lines) - len(kept), sha("\n".join(kept).encode()))
    return out


def op10(docs: list[tuple[int, str | None]], width: int = 20) -> dict[int, tuple]:
    seen, out = set(), {}
    for doc, text in docs:
        w = WORD.findall(text or "")
        late = []
        for i in range(len(w) - width + 1):
            s = tuple(w[i : i + width])
            if s in seen:
                late.append(i)
            else:
                seen.add(s)
        gone = merged(len(w), late, width)
        out[doc] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()))
    return out


def luhn(d: str) -> bool:
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def op9(docs: list[tuple[int, str | None]]) -> dict[int, tuple]:
    """Counts of the base kinds and the hash of their spans."""
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    ]
    out = {}
    for doc, text in docs:
        found = [[(m.start(), i, m.end()) for m in re.finditer(p, text or "") if ok(m[0])] for i, (p, ok) in enumerate(kinds)]
        base = ",".join(f"{('email', 'ip', 'card', 'phone')[i]}:{a}:{b}" for a, i, b in sorted(x for f in found for x in f))
        out[doc] = (*map(len, found), sha(base.encode()))
    return out


def topic(text: str) -> str:
    has = lambda *parts: any(p in text for p in parts)
    rules = [
        ("secrets", has("password=", "password:", "token =", "secret=", "AKIA")),
        ("licence", has("License", "Licence", "license", "licence", "Copyright", "All rights reserved")),
        ("contact", has("@", " +")),
        ("tabular", has(" | ")),
        ("markup", has("##", "**", "$$", "%%", "&&", "</")),
        ("shouting", has("!!")),
        ("figures", bool(re.search("[0-9]{4}", text))),
        ("long_form", len(text) > 8000),
    ]
    return next((name for name, ok in rules if ok), "prose")


def op1(docs: list[tuple], alphas=(0.5, 0.7, 0.7), keep: float = 0.5, rounds: int = 200, tol: float = 1e-9, seed: int = 42) -> dict[int, tuple]:
    """doc_id: (topic, tokens, probability, sampled) of (doc_id, text, lang, source)."""
    cell = {i: (source, lang, topic(text or "")) for i, text, lang, source in docs}
    size = {i: len(WORD.findall(text or "")) for i, text, _, _ in docs}
    tokens = Counter()
    for i, c in cell.items():
        tokens[c] += size[i]
    goals = []
    for d, alpha in enumerate(alphas):
        have = Counter()
        for c, n in tokens.items():
            have[c[d]] += n
        up = {v: n**alpha if n else 0.0 for v, n in have.items()}
        goals.append({v: x / sum(up.values()) for v, x in up.items()})
    total = sum(tokens.values())
    w = {c: n / total for c, n in tokens.items()}
    for _ in range(rounds):
        worst = 0.0
        for d, goal in enumerate(goals):
            have = Counter()
            for c, x in w.items():
                have[c[d]] += x
            scale = {v: goal[v] / h if h > 0 else 1.0 for v, h in have.items()}
            worst = max([worst, *(abs(x - 1) for x in scale.values())])
            w = {c: x * scale[c[d]] for c, x in w.items()}
        if worst < tol:
            break
    p = lambda k, c: 1.0 if not tokens[c] else min(1.0, k * w[c] / tokens[c])
    low, high = 1e-3, 1e30
    for _ in range(400):  # by bisection on a scale of logarithms
        mid = math.sqrt(low * high)
        low, high = (mid, high) if sum(p(mid, c) * n for c, n in tokens.items()) < keep * total else (low, mid)
    out = {}
    for i, c in cell.items():
        h = xxhash.xxh64_intdigest(struct.pack("<i", seed), xxhash.xxh64_intdigest(struct.pack("<q", i), 42))
        out[i] = (c[2], size[i], p(high, c), (h >> 11) * 2.0**-53 < p(high, c))
    return out


def op4(text: str, model, buckets: int) -> list[float]:
    """Mean weighted loss of each codeword, number by number."""
    low = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode()]
    counts = Counter()
    for a, b, c in zip(low, low[1:], low[2:]):
        if (a, b) != (32, 32):
            h = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) % 2**32
            h = (h ^ h >> 15) * 0x2C1B3C6D % 2**32
            counts[(h >> 20) % buckets] += 1
    n = max(sum(counts.values()), 1)
    out = []
    for word in model.code:
        loss = 0.0
        for j, bit in enumerate(word):
            margin = sum(k * model.weights[b, j] for b, k in counts.items()) / n
            z = min(max(margin * model.scale[j], -30), 30)
            loss += model.trust[j] * math.log1p(math.exp(-z * bit))
        out.append(loss / sum(model.trust))
    return out


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def op11(docs: list[tuple[str | None, str | None]], least: int = 10, top: int = 2000, share: int = 50) -> set[tuple]:
    """docs: (lang, text).  Rows (lang, rank, phrase, a, l, r, n, score)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = {q for p, a in found.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= share * counts[q]}
        rows = []
        for p, a in found.items():
            cuts = [(1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            s, k = min(cuts)
            if p not in inside:
                rows.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return out


def op12_base(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, by start and then kind as listed."""
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.ASCII) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(a, b, kind) for a, _, b, kind in sorted(found)]


def op13(docs: list[tuple[str | None, str | None, str | None]], least: int = 10, top: int = 10) -> set[tuple]:
    """docs: (lang, source, text).  Rows (lang, source, part, item, value, rank)."""
    df, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        terms = [t.translate(LOWER) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]
        groups[lang].add(source)
        df[lang].update(set(terms))
        counts[lang, source].update(terms)
    gap = lambda p, q: (p - q) ** 2 // (p + q)
    out = set()
    for lang, sources in groups.items():
        kept = {t for t, k in df[lang].items() if k >= least}
        v = len(kept)
        own = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        whole = {t: sum(own[s][t] for s in sources) for t in kept}
        prob = lambda c: {t: 1 + 1000000000 * (x + 2) // (sum(c.values()) + 2 * v) for t, x in c.items()}  # noqa: E731, B023
        p, q = {s: prob(c) for s, c in own.items()}, prob(whole)
        for s in sources:
            pairs = sorted((-sum(gap(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            terms = sorted((-gap(p[s][t], q[t]), t.encode()) for t in kept if own[s][t] and p[s][t] > q[t])[:top]
            for part, rows in (("pair", pairs), ("term", terms)):
                out |= {(lang, s, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(rows, 1)}
    return out
