"""Plain versions of the operators, and rows that hold the awkward cases."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, d long, th string, key string"


def passage(seed, n):
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i * seed) % 5003}" for i in range(n))


def awkward():
    """Nulls, empty and long texts, ties, repeated rows, copies, shared passages, columns with names used inside."""
    a, b, c = passage(1, 90), passage(2, 120), passage(3, 60)
    texts = [
        (1, a), (2, a), (3, f"{passage(4, 30)} {a[:260]} {passage(5, 30)}"), (4, None), (5, ""), (6, "   \n\t "),
        (7, b + " end"), (8, "start " + b), (9, c), (9, c), (9, b), (None, c + " tail"), (None, None), (10, "x" * 700),
        (11, "ab " * 200), (12, "one two"), (13, "one two"), (14, f"{passage(6, 2000)} {b} {passage(7, 2000)}"),
        (15, "é" * 150 + " " + "ü" * 150), (16, a.replace("w1", "v1", 3)), (17, "the " * 60), (18, "word"), (19, passage(8, 20)),
        (20, passage(8, 20) + " more"), (21, passage(9, 24)), (22, passage(9, 23) + " else"),
    ]
    return [(i, t, "en" if k % 3 else None, f"s{k % 4}" if k % 5 else None, None, 7, "x", "y") for k, (i, t) in enumerate(texts)]


def op1(rows, window=200):
    where = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for n, (_, t) in enumerate(texts):
        for p in range(len(t) - window + 1):
            where.setdefault(t[p : p + window], []).append((n, p))
    gone = [bytearray(len(t)) for _, t in texts]
    for places in where.values():
        if len(places) > 1:
            for n, p in places:
                gone[n][p : p + window] = b"\1" * window
    out = []
    for (i, t), g in zip(texts, gone):
        kept = bytes(x for x, y in zip(t, g) if not y)
        out.append((i, len(t), sum(g), len(re.findall(b"\1+", bytes(g))), hashlib.sha256(kept).hexdigest()))
    return out


def op4(rows, window=20):
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    keys = [(2**63 if i is None else i, w) for i, w in texts]
    for k, (i, w) in zip(keys, texts):
        for p in range(len(w) - window + 1):
            seq = tuple(w[p : p + window])
            at = (k[0], p)
            first[seq] = min(first.get(seq, at), at)
    out = []
    for k, (i, w) in zip(keys, texts):
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < (k[0], p):
                gone[p : p + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def ascii_lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


def op5(rows, k=5):
    sets = []
    for _, t in rows:
        w = WORD.findall(ascii_lower(t))
        sets.append({tuple(w[p : p + k]) for p in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    by = {}
    for n, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(n)
    pairs = {(a, b) for g in by.values() for a in g for b in g if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            label[root(a)] = root(b)
    least = {}
    for n, (i, _) in enumerate(rows):
        r = root(n)
        ids = [x for x in (least.get(r), i) if x is not None]
        least[r] = min(ids) if ids else None
    return [(i, len(s), least[root(n)], i == least[root(n)]) for n, ((i, _), s) in enumerate(zip(rows, sets))]


ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def op10(rows, items, width=10):
    windows = {}
    for i, t in items:
        w = ALNUM.findall(ascii_lower(t))
        for p in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[p : p + width]), set()).add("" if i is None else str(i))
    sizes = {len(w) for w in windows}
    out = []
    for i, t in rows:
        w = ALNUM.findall(ascii_lower(t))
        hit, found = [False] * len(w), set()
        for k in sizes:
            for p in range(len(w) - k + 1):
                if (own := windows.get(tuple(w[p : p + k]))):
                    hit[p : p + k] = [True] * k
                    found |= own
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), sum(hit), len(found), sha, any(hit)))
    return out


def thue_morse(n, letters="ab"):
    """Two different words of n letters that a polynomial modulo a power of two takes for one."""
    bits = [bin(k).count("1") % 2 for k in range(n)]
    return "".join(letters[b] for b in bits), "".join(letters[1 - b] for b in bits)
