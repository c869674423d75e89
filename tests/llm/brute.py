"""Plain single-text forms of the operators, for comparison on small tables."""

import hashlib
import math
import re
import string
import zlib
from collections import Counter, defaultdict

import pyarrow as pa

_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SPACED = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return (text or "").translate(_LOWER)


def crc_rest(doc_id, modulus):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % modulus


def documents(spark, rows):
    """A documents table of (doc_id, text) rows with extra, clashing columns."""
    names = ["doc_id", "text", "lang", "source", "n_chars", "score", "row", "keys", "vote", "redacted", "row_key", "count"]
    made = [(i, t, None, None, None, "x", 1, "k", None, "r", 5, 7) for i, t in rows]
    return spark.createDataFrame(
        made, "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, `row` int, keys string, vote string, "
        "redacted string, row_key int, count int").select(*names)


ODD_TEXTS = [
    None, "", " ", "\n\t", "a", "A", "one two", "one two three", "one two three four", "x" * 5000, "word " * 3000, "É é ß 漢字 🙂 end", "...", "123",
    "same text here for all of us to see again", "same text here for all of us to see again", "line\nline\nline\nline", "\x00\x01 odd \x7f bytes",
]


def odd_rows(start=0):
    """Texts of every odd kind, a null id and a repeated row."""
    rows = [(start + i, t) for i, t in enumerate(ODD_TEXTS)]
    return [*rows, (None, "no id here at all"), (None, None), rows[4], rows[10]]


# Personal data

def _luhn(digits):
    values = [int(c) for c in digits][::-1]
    return (sum(values[0::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def base_spans(text):
    spans, text = [], text or ""
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        spans.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            spans.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            spans.append((m.start(), 3, m.end(), "phone"))
    return [(kind, a, b) for a, _, b, kind in sorted(spans)]


def base_sha256(text):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(text)).encode()).hexdigest()


# Repetition

def repetition(text):
    text = text or ""
    words = SPACED.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    counts, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered |= set(range(i, i + 5))
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            repeated += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered))


# Contamination

def contamination(text, items):
    words = ALNUM.findall(lower(text))
    hit, found = set(), set()
    for item_id, item in items:
        known = ALNUM.findall(lower(item))
        size = min(10, len(known))
        windows = {tuple(known[i:i + size]) for i in range(len(known) - size + 1)} if known else set()
        for i in range(len(words) - size + 1):
            if windows and tuple(words[i:i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add(item_id)
    listed = sorted(str(i) for i in found if i is not None)
    return len(words), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)


# Near duplicates

def shingle_set(text, size):
    words = SPACED.findall(lower(text))
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def near_duplicates(rows, size=5):
    """Set size and component of each (doc_id, text) row; every pair is compared."""
    sets = [(i, shingle_set(t, size)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    usable = [(i, s) for i, s in sets if i is not None and s]
    for n, (i, a) in enumerate(usable):
        for j, b in usable[n + 1:]:
            same = len(a & b)
            if 100 * same >= 80 * (len(a) + len(b) - same):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sorted(((i, len(s), None if i is None else find(i), i is not None and find(i) == i) for i, s in sets), key=repr)


# Language model

def language_model(rows, discount=0.75):
    """Held-out flag, token counts, base score and model score of each (doc_id, text) row."""
    tokens = [(i, SPACED.findall(lower(t)) + [None]) for i, t in rows]
    train = [t for i, t in tokens if crc_rest(i, 10)]
    one = Counter(w for t in train for w in t)
    two = Counter(p for t in train for p in zip(t, t[1:]))
    three = Counter(p for t in train for p in zip(t, t[1:], t[2:]))
    total, words = sum(one.values()), len(one)
    once, twice = (sum(c == k for c in one.values()) for k in (1, 2))
    first = min(0.95, max(0.05, once / max(1, once + 2 * twice)))
    after_one, after_two = defaultdict(float), defaultdict(float)
    for (a, _), n in two.items():
        after_one[a] += (n - discount) / one[a] if n > 1 else 0
    for (a, b, _), n in three.items():
        after_two[a, b] += (n - discount) / two[a, b] if n > 1 else 0
    out = []
    for i, text in tokens:
        base = score = 0.0
        for k, w in enumerate(text):
            base += math.log10((one[w] + 0.1) / (total + 0.1 * (words + 1)))
            p = ((one[w] - first) if one[w] else first * words) / total if total else 1.0
            if k and one[text[k - 1]]:
                b = text[k - 1]
                p = p * (1 - after_one[b]) + (max(two[b, w] - discount, 0) / one[b] if two[b, w] > 1 else 0)
                if k > 1 and two[text[k - 2], b] > 1:
                    a = text[k - 2]
                    p = p * (1 - after_two[a, b]) + (max(three[a, b, w] - discount, 0) / two[a, b] if three[a, b, w] > 1 else 0)
            score += math.log10(min(1.0, p))
        out.append((i, crc_rest(i, 10) == 0, len(text), sum(one[w] > 0 for w in text), total, base, score))
    return out


def texts(column):
    return pa.array(column, pa.string())
