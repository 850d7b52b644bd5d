"""Plain single-process versions of the operators' contracts, for small fixtures."""

import hashlib
import re
import zlib

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def sha(data):
    return hashlib.sha256(data).hexdigest()


def crc(value):
    return zlib.crc32(value.encode())


def shingles(text, k):
    words = SPACE_WORD.findall((text or "").translate(LOW))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def near_duplicates(rows, k, percent):
    """rows: (id, text). -> id -> (set size, component), for ids that occur once."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[a + 1 :]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    return {i: (len(s), find(i)) for i, s in sets}


def window_dedup(rows, window=50):
    rows = sorted(rows)
    least, out = {}, {}
    for i, t in rows:
        words = SPACE_WORD.findall(t or "")
        for k in range(len(words) - window + 1):
            least.setdefault(tuple(words[k : k + window]), i)
    for i, t in rows:
        words = SPACE_WORD.findall(t or "")
        gone = set()
        for k in range(len(words) - window + 1):
            if least[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        out[i] = (len(words), len(gone), sha(" ".join(w for k, w in enumerate(words) if k not in gone).encode()))
    return out


def byte_dedup(rows, length=50):
    rows = sorted(rows)
    least, out = {}, {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            least.setdefault(b[k : k + length], i)
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if least[b[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return out


def licenses(text):
    words = ALNUM_WORD.findall((text or "").translate(LOW))
    found = [(k, label) for phrase, label in PHRASES.items() for k in range(len(words)) if tuple(words[k : k + len(phrase)]) == phrase]
    at = [k for k, _ in found]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii(text):
    spans, counts = [], []
    for rank, (kind, pattern) in enumerate(PII.items()):
        n = 0
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False, "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                n += 1
                spans.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
        counts.append(n)
    return (*counts, sha(",".join(s for _, _, s in sorted(spans)).encode()))
