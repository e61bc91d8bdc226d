"""Plain-Python versions of the operators' rules, for small tables."""

import hashlib
import re

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def substring(rows, window=13):
    first = {}
    words = [BLANK.findall(t or "") for _, t in rows]
    for (d, _), w in zip(rows, words):
        if d is not None:
            for i in range(len(w) - window + 1):
                k = tuple(w[i:i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for (d, _), w in zip(rows, words):
        gone = [False] * len(w)
        if d is not None:
            for i in range(len(w) - window + 1):
                if first[tuple(w[i:i + window])] < d:
                    gone[i:i + window] = [True] * window
        out.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def decontam(rows, items, window=13):
    phrases = {}
    for i, t in items:
        w = ALNUM.findall((t or "").translate(AZ))
        if i is not None and w:
            k = min(window, len(w))
            for j in range(len(w) - k + 1):
                phrases.setdefault(tuple(w[j:j + k]), set()).add(i)
    sizes = {len(p) for p in phrases}
    out = []
    for d, t in rows:
        w = ALNUM.findall((t or "").translate(AZ))
        hit, own = set(), set()
        for k in sizes:
            for j in range(len(w) - k + 1):
                if (p := tuple(w[j:j + k])) in phrases:
                    hit.update(range(j, j + k))
                    own |= phrases[p]
        out.append((d, len(w), len(hit), len(own), sha(",".join(sorted(map(str, own)))),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def simhash(rows, shingle=3, bits=3):
    from xxhash import xxh64_intdigest

    fps = []
    for d, t in rows:
        w = BLANK.findall((t or "").translate(AZ))
        s = [" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
        h = [xxh64_intdigest(x.encode(), 42) for x in s]
        fps.append((d, sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))))
    parent = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= bits:
                parent[find(parent, i)] = find(parent, j)
    least = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            r = find(parent, i)
            least[r] = min(least.get(r, d), d)
    return [(d, f"{f:016x}", least.get(find(parent, i))) for i, (d, f) in enumerate(fps)]


def quality_base(rows):
    out = []
    for d, t in rows:
        t = t or ""
        w = BLANK.findall(t)
        lines = [x for x in t.split("\n") if BLANK.search(x)]
        seen = {}
        for i in range(len(w) - 7):
            seen.setdefault(tuple(w[i:i + 8]), []).append(i)
        rep = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
        out.append((d, len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
                    len(rep), len(w) < 20 or 100 * len(rep) > 30 * len(w)))
    return out


SECRETS = [("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)),
           ("access", re.compile("AKIA[A-Z0-9]+")), ("hex", re.compile("[0-9a-f]+"))]


def secrets(rows):
    out = []
    for d, t in rows:
        t = t or ""
        spans = []
        for i, (kind, p) in enumerate(SECRETS):
            for m in p.finditer(t):
                if (len(m[2]) >= 6 if i == 0 else len(m[0]) >= (20 if i == 1 else 24)):
                    spans.append((m.start(), i, m.end()))
        n = [sum(s[1] == i for s in spans) for i in range(3)]
        out.append((d, *n, sha(",".join(f"{SECRETS[i][0]}:{s}:{e}" for s, i, e in sorted(spans)))))
    return out


RUN = re.compile("[A-Za-z0-9+/_=-]+")
CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"


def ratio(token, model):
    codes = [CHARS.find(c) + 1 for c in token]
    total = 0.0
    for a, b in zip(codes, codes[1:]):
        total += model[a * (len(CHARS) + 1) + b]
    return total


def secret_spans(text, model, min_ratio=12.0):
    """All spans of a text: the base ones, and random-looking runs that no base one holds."""
    spans = []
    for i, (kind, p) in enumerate(SECRETS):
        spans += [(m.start(), i, m.end()) for m in p.finditer(text)
                  if (len(m[2]) >= 6 if i == 0 else len(m[0]) >= (20 if i == 1 else 24))]
    held = list(spans)
    for m in RUN.finditer(text):
        if len(m[0]) >= 16 and ratio(m[0], model) >= min_ratio and \
                not any(s <= m.start() and m.end() <= e for s, _, e in held):
            spans.append((m.start(), 3, m.end()))
    names = ("assign", "access", "hex", "markov")
    return ",".join(f"{names[i]}:{s}:{e}" for s, i, e in sorted(spans))


def runs(words, min_length=6, min_exponent=4):
    """(start, length, period) of all periodic runs, by start and period."""
    n, out = len(words), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            e = i + q
            if i > s and e - s >= max(min_length, min_exponent * q) and \
                    not any(all(words[x] == words[x + r] for x in range(s, e - r)) for r in range(1, q)):
                out.append((s, e - s, q))
            i = max(i, s + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))
