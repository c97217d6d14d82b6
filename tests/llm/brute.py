"""Plain Python versions of the operators' contracts, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    covered = {p + k for found in windows.values() if len(found) > 1 for p in found for k in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def repeated_bytes(texts, size=200):
    """Per text: bytes, removed bytes, removed runs, digest of the rest."""
    data = [(t or "").encode() for t in texts]
    found = Counter(d[i : i + size] for d in data for i in range(len(d) - size + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - size + 1):
            if found[d[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        rest = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(rest)))
    return out


def repeated_words(rows, size=20):
    """Rows (doc_id, text); per row words, removed words, digest of the rest. The first occurrence stays."""
    seen, out = set(), {}
    for k, (doc_id, text) in sorted(enumerate(rows), key=lambda x: (x[1][0] is None, x[1][0] or 0, x[0])):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            if window in seen:
                gone[i : i + size] = [True] * size
            seen.add(window)
        kept = [w for w, g in zip(words, gone) if not g]
        out[k] = (doc_id, len(words), sum(gone), sha(" ".join(kept)))
    return [out[k] for k in range(len(rows))]


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lower)
    if not words:
        return set()
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) >= 3 else {tuple(words)}


def components(rows):
    """Rows (doc_id, text); (doc_id, n_shingles, component_id), every pair compared."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            holders[g].append(k)
    overlap = Counter()
    for found in holders.values():
        for i, a in enumerate(found):
            for b in found[i + 1 :]:
                overlap[a, b] += 1
    for (a, b), n in overlap.items():
        if 100 * n >= 90 * (len(sets[a]) + len(sets[b]) - n):
            parent[root(a)] = root(b)
    least = defaultdict(list)
    for k, (doc_id, _) in enumerate(rows):
        least[root(k)].append(doc_id)
    return [(rows[k][0], len(sets[k]), min((d for d in least[root(k)] if d is not None), default=None)) for k in range(len(rows))]


SECRETS = (
    ("assign", re.compile(r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 6, 1),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 20, 0),
    ("hex", re.compile(r"[0-9a-f]+"), 24, 0),
)


def secrets(text):
    found = []
    for order, (kind, pattern, least, group) in enumerate(SECRETS):
        found += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text or "") if len(m[group]) >= least]
    counts = Counter(s.partition(":")[0] for _, _, s in found)
    return counts["assign"], counts["access"], counts["hex"], sha(",".join(s for _, _, s in sorted(found)))


def url_parts(url):
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]


RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def url_rule(url):
    host, path = url_parts(url)
    fit = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


def water_fill(sizes, weights, budget, epochs=2.0):
    """Targets by source: clamp and share again until no source is above its limit."""
    clamped = set()
    while True:
        left = budget - sum(epochs * sizes[s] for s in clamped)
        total = sum(weights[s] for s in sizes if s not in clamped)
        target = {s: epochs * sizes[s] if s in clamped else left * weights[s] / total for s in sizes}
        above = {s for s in sizes if s not in clamped and target[s] >= epochs * sizes[s]}
        if not above:
            return target
        clamped |= above
        if len(clamped) == len(sizes):
            return {s: epochs * sizes[s] for s in sizes}
