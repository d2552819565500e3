"""Plain Python versions of the operators' results, straight from their definitions."""

import hashlib
import re
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(raw):
    return hashlib.sha256(raw if isinstance(raw, bytes) else raw.encode()).hexdigest()


def line_dedup(docs, min_docs, keep="none"):
    keys, places = Counter(), {}
    for _, text in docs:
        keys.update({k for k in (lower(x.strip(SPACE)) for x in (text or "").split("\n")) if k})
    for doc, text in docs:
        for i, x in enumerate((text or "").split("\n")):
            k, place = lower(x.strip(SPACE)), (doc is None, doc, i)
            places[k] = min(places.get(k, place), place)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [
            x
            for i, x in enumerate(lines)
            if not (k := lower(x.strip(SPACE))) or keys[k] < min_docs or (keep == "first" and places[k] == (doc is None, doc, i))
        ]
        out.append((doc, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def shingle_set(text, n):
    w = WORD.findall(lower(text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def jaccard(docs, n, percent):
    sets = [(doc, shingle_set(text, n)) for doc, text in docs]
    root = {doc: doc for doc, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            index[x].append(i)
    for i, (doc, s) in enumerate(sets):
        shared = Counter(j for x in s for j in index[x] if j < i)
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j][1]) - both):
                a, b = find(doc), find(sets[j][0])
                root[max(a, b)] = min(a, b)
    return [(doc, len(s), find(doc)) for doc, s in sets]


LEAK_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def leaks(docs, items, window):
    windows = defaultdict(set)
    for item, text in items:
        w = LEAK_WORD.findall(lower(text or ""))
        for i in range(max(1, len(w) - window + 1)) if w else ():
            windows[tuple(w[i : i + window])].add(str(item))
    sizes = sorted({len(x) for x in windows})
    out = []
    for doc, text in docs:
        w = LEAK_WORD.findall(lower(text or ""))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if ks := windows.get(tuple(w[i : i + size])):
                    hit |= set(range(i, i + size))
                    found |= ks
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def quality(docs):
    out = []
    for doc, text in docs:
        text = text or ""
        w = WORD.findall(text)
        grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        repeat = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in text.split("\n") if x.strip(SPACE)]
        failed = len(w) < 10 or 100 * len(repeat) > 20 * len(w)
        symbols = sum(c in "#*$%&|<>" for c in text)
        out.append((doc, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeat), failed))
    return out


def secrets(text):
    return _spans(
        text or "",
        {
            "assign": (r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
            "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
            "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
        },
    )


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(m):
    return re.sub("[^0-9]", "", m[0])


def private(text):
    return _spans(
        text or "",
        {
            "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
            "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
            "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(_digits(m)) <= 19 and luhn(_digits(m))),
            "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(_digits(m)) <= 15),
        },
    )


def _spans(text, kinds):
    found = []
    for order, (kind, (pattern, fine)) in enumerate(kinds.items()):
        found += [(m.start(), order, kind, m.end()) for m in re.finditer(pattern, text) if fine(m)]
    counts = [sum(x[2] == k for x in found) for k in kinds]
    return counts, ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


def repeats(docs, size):
    """Bytes covered by a string of ``size`` bytes that also starts earlier, over documents sorted by id."""
    seen, out = set(), []
    for doc, text in sorted(docs):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - size + 1):
            piece = raw[i : i + size]
            if piece in seen:
                gone[i : i + size] = b"\x01" * size
            seen.add(piece)
        spans = len(re.findall(b"\x01+", bytes(gone)))
        out.append((doc, len(raw), sum(gone), spans, sha(bytes(b for b, g in zip(raw, gone, strict=True) if not g))))
    return out
