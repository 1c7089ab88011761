"""What the operators should return, computed row by row in plain Python."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np

from laborlens.llm import bytesops

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def words(text, lower=False):
    data = (text or "").encode()
    return (data.translate(LOWER) if lower else data).split()


def quality(text):
    text = text or ""
    w = words(text)
    windows = collections.Counter(zip(w, w[1:], w[2:]))
    again = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i : i + 3])] > 1:
            again |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if words(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(len(x.decode()) for x in w),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(again),
    }


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_secrets(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(out)]


def line_dedup(rows, min_chars=40):
    """doc_id -> (n_lines, n_removed, digest); rows of (doc_id, text) with distinct ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        lines = (text or "").split("\n")
        filled = [i for i, x in enumerate(lines) if x]
        gone = dict.fromkeys(filled, False)
        for s in range(len(filled)):
            # Every stretch of enough characters; those longer than it takes hold nothing else than shorter ones from either end.
            for e in range(s, min(len(filled), s + min_chars)):
                stretch = tuple(lines[i] for i in filled[s : e + 1])
                size = sum(map(len, stretch))
                if size < min_chars:
                    continue
                if size - len(stretch[-1]) < min_chars or size - len(stretch[0]) < min_chars:
                    if stretch in seen:
                        gone |= dict.fromkeys(filled[s : e + 1], True)
                    seen.add(stretch)
                else:
                    break
        flags = []
        for i, x in enumerate(lines):
            before = [gone[j] for j in filled if j <= i][-1:]
            after = [gone[j] for j in filled if j >= i][:1]
            flags.append(bool(before or after) and all(before + after))
        out[doc_id] = (len(lines), sum(flags), sha("\n".join(x for x, g in zip(lines, flags) if not g)))
    return out


def repeats(texts, length=200):
    """For each text (bytes): n_removed, n_spans and the rest, in order."""
    times = collections.Counter(t[s : s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if times[t[s : s + length]] > 1:
                gone[s : s + length] = b"\x01" * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def gear_cuts(data, gear, memory=12, near=14, longest=1024):
    """Ends of the chunks of a text: where the hash of the last bytes is the smallest (first of equal ones) on both sides."""
    h = [0] * len(data)
    for i in range(memory - 1, len(data)):
        for b in data[i - memory + 1 : i + 1]:
            h[i] = (h[i] << 1) + gear[b] & 0xFFFFFFFF
    cuts = []
    for i in range(memory + near - 1, len(data) - near):
        around = [(h[j], j) for j in range(i - near, i + near + 1)]
        if min(around) == (h[i], i):
            cuts.append(i + 1)
    out, at = [], 0
    for c in [*cuts, len(data)] if data else []:
        while c - at > longest:
            at += longest
            out.append(at)
        if c > at:
            out.append(c)
            at = c
    return out


def pieces(data, ends, shortest):
    """Starts and ends of the stretches of chunks of ``shortest`` bytes, by start."""
    starts = [0, *ends[:-1]] if ends else []
    out = set()
    for s in starts:
        far = [e for e in ends if e - s >= shortest]
        if far:
            out.add((s, far[0]))
    out |= {max((s, ends[-1]) for s in starts if ends[-1] - s >= shortest)} if ends and ends[-1] >= shortest else set()
    return sorted(out)


def shingles(text, n):
    w = words(text, lower=True)
    return frozenset(zip(*(w[i:] for i in range(n)))) if len(w) >= n else frozenset([tuple(w)] if w else [])


def components(rows, n, percent):
    """doc_id -> (set size, smallest reachable id)."""
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            holders[s].append(i)
    common = collections.Counter()
    for ids in holders.values():
        for k, b in enumerate(ids):
            for a in ids[:k]:
                common[a, b] += 1
    for (a, b), both in common.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i)) for i in sets}


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % 5 == 1


def base_scores(rows):
    """(n_tokens, n_known, N, base score) of each row, in order."""
    tokens = [words(t, lower=True) + [None] for _, t in rows]
    count = collections.Counter(w for (i, _), ws in zip(rows, tokens) if not held_out(i) for w in ws)
    total = sum(count.values())
    below = total + 0.5 * (len(count) + 1)
    return [
        (len(ws), sum(count[w] > 0 for w in ws), total, sum(math.log10((count[w] + 0.5) / below) for w in ws)) for ws in tokens
    ]


def word_hash(word):
    """The 64-bit hash by which the language model knows a word."""
    data = np.frombuffer(word.encode() + b" ", np.uint8)
    return int(bytesops.Prefix(data).spans(np.array([0]), np.array([len(data) - 1]))[0])


def maxent_scores(rows, held, settings):
    """(doc_id, score) of each row by the two softmaxes, trained by one update over all training words; loops and dicts only."""
    m = 1 << 64

    def mix(h):
        for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            h = (h ^ h >> 33) * factor % m
        return h ^ h >> 33

    width, own, end, begin = settings.CLASSES, settings.OWN, int(settings.END), int(settings.BEGIN)
    shared = width - own
    texts = [[word_hash(w.decode()) for w in words(t, lower=True)] + [end] for _, t in rows]
    count = collections.Counter(w for (i, _), ws in zip(rows, texts, strict=True) if not held(i) for w in ws)
    size = settings.feature_rows(sum(count.values()))
    first = sorted(count, key=lambda w: (-count[w], w))[: width * own]
    place = {w: (r % width, r // width) for r, w in enumerate(first)}

    def leaf(w):
        return place.get(w) or (w % (width * shared) // shared, own + w % shared)

    mass = {(c, s): 0.5 for c in range(width) for s in range(width)}
    for w, n in count.items():
        mass[leaf(w)] += n if w in place else n + 0.5
    weights = {("class", "always"): [math.log(sum(mass[c, s] for s in range(width))) for c in range(width)]}
    for c in range(width):
        weights["slot", c, "always"] = [math.log(mass[c, s]) for s in range(width)]

    def events(ws):
        """The features on and the outcome, of the class and of the slot, for each word."""
        for i, w in enumerate(ws):
            one, two = ws[i - 1] if i else begin, ws[i - 2] if i > 1 else begin
            seen = [mix((one + 11) % m), mix((mix((one + 22) % m) + two) % m), mix((two + 33) % m)]
            c, s = leaf(w)
            salted = [mix(h ^ mix(c + 77)) for h in seen]
            yield w, [
                ([("class", "always")] + [("class", k, h % size) for k, h in enumerate(seen)], c),
                ([("slot", c, "always")] + [("slot", k, h % size) for k, h in enumerate(salted)], s),
            ]

    def softmax(on):
        z = [math.exp(sum(weights[f][j] for f in on if f in weights)) for j in range(width)]
        return [x / sum(z) for x in z]

    gradient = collections.defaultdict(lambda: [0.0] * width)
    for (i, _), ws in zip(rows, texts, strict=True):
        for _, steps in events(ws) if not held(i) else []:
            for on, outcome in steps:
                p = softmax(on)
                for f in on:
                    for j in range(width):
                        gradient[f][j] += p[j] - (j == outcome)
    for f, g in gradient.items():
        energy = settings.ENERGY + sum(x * x for x in g) / width
        weights[f] = [w - settings.STEP * x / energy**0.5 for w, x in zip(weights.get(f, [0.0] * width), g, strict=True)]

    def score(ws):
        total = 0.0
        for w, steps in events(ws):
            share = 1 if w in place else (count[w] + 0.5) / mass[leaf(w)]
            # A shared slot counts one unseen word besides its own.
            total += math.log10(share) + sum(math.log10(softmax(on)[outcome]) for on, outcome in steps)
        return total

    return [(i, score(ws)) for (i, _), ws in zip(rows, texts, strict=True)]


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lexical(rows, items, most=10):
    """(item, rank, doc_id, score) of all items; rows and items of (id, text)."""

    def terms(text):
        return TERM.findall((text or "").encode().translate(LOWER).decode())

    docs = [(i, collections.Counter(terms(t))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    total = sum(sum(c.values()) for _, c in docs)
    df = collections.Counter(t for _, c in docs for t in c)
    asked = collections.defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms(t))
    out = []
    for item, own in asked.items():
        scored = []
        for i, c in docs:
            m = 10 + 90 * sum(c.values()) * len(docs) // total
            score = 0
            for t in own & set(c):
                w = math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1)))
                score += w * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(scored[:most])]
    return out


def periodic(words, least=12):
    """(start, length, period) of all runs of a list of words, by trying every period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def made_periodic(doc_id, text):
    w, h = words(text), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def periodic_report(doc_id, text):
    w = made_periodic(doc_id, text)
    runs = periodic(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(listed), sha(kept))
