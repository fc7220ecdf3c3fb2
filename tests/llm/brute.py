"""Plain Python versions of the contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
sha = lambda s: hashlib.sha256(s.encode() if isinstance(s, str) else s).hexdigest()


def mix_targets(rows):
    """rows (doc_id, text, source) -> source -> (size, target)."""
    size = Counter()
    for _, text, source in rows:
        size[source] += len(WORD.findall(text or ""))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped, target = sum(size.values()), set(), {}
    while True:
        left = total - sum(3 * size[s] for s in capped)
        w = sum(weight[s] for s in order if s not in capped)
        target = {s: 3.0 * size[s] if s in capped else left * weight[s] / w for s in order}
        over = {s for s in order if target[s] > 3 * size[s] and s not in capped}
        if not over:
            return {s: (size[s], target[s]) for s in order}
        capped |= over


def rule_measures(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    places = {i + j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n_repeat = len(places)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), n_repeat,
            len(w) < 50 or 100 * n_repeat > 50 * len(w))


def line_dedup(rows):
    """rows (doc_id, text), doc_ids distinct -> doc_id -> (n_lines, n_dropped, sha)."""
    blanks = " \t\n\x0b\x0c\r"
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(blanks))
    held = defaultdict(set)
    for d, text in rows:
        for x in (text or "").split("\n"):
            held[key(x)].add(d)
    out = {}
    for d, text in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if len(key(x)) < 40 or len(held[key(x)]) < 5 or max(held[key(x)]) == d]
        out[d] = (len(lines), len(lines) - len(keep), sha("\n".join(keep)))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def personal(text):
    """[(kind, start, end)] in order of kind and start."""
    text, out = text or "", []
    tests = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda v: 13 <= len(d := re.sub("[^0-9]", "", v)) <= 19 and luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(re.sub("[^0-9]", "", v)) <= 15),
    }
    for kind, (pattern, valid) in tests.items():
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if valid(m.group())]
    return out


def lpf_removal(rows, width=100):
    """rows (doc_id, text), doc_ids distinct -> doc_id -> (n_bytes, n_removed, n_spans, sha)."""
    seen, out = set(), {}
    for d, text in sorted(rows):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - width + 1):
            w = b[s:s + width]
            if w in seen:
                gone[s:s + width] = b"\1" * width
            seen.add(w)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g)))
    return out


def shingles(text):
    w = WORD.findall(text or "")
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def near_classes(rows, least=0.8):
    """rows (doc_id, text) -> doc_id -> smallest doc_id of its component over weighted Jaccard >= least."""
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    index = defaultdict(set)
    for d in ids:
        for s in sets[d]:
            index[s].add(d)
    for a in ids:
        for b in {x for s in sets[a] for x in index[s] if x > a}:
            x, y = sets[a], sets[b]
            both = sum((x & y).values())
            if both >= least * (sum(x.values()) + sum(y.values()) - both) - 1e-9:
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {d: root(d) for d in ids}
