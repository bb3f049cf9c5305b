"""Plain Python versions of the operators, and small tricky tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SPACES = b"\t\n\x0b\x0c\r "
# Columns beside those of documents, named like columns the operators use themselves.
CLASHES = ["row", "name", "level", "fp", "size", "key", "words", "found", "_id", "_key", "lang_pred"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"`{c}` string" for c in CLASHES
)


def tricky_docs() -> list[tuple]:
    """Null, empty, blank, short, equal, nearly equal, repeated and very long texts; null ids."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(1, 7))) for _ in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    long = " ".join(rng.choices(vocabulary, k=4_000))
    other = " ".join(rng.choices(vocabulary, k=80))
    near = other.split(" ")
    near[79] = "changed"
    texts = [
        (0, None), (1, ""), (2, " \t\n\x0b "), (3, "a"), (3, "a"), (4, "a  b\tc"), (5, "a b c"),
        (6, "a b c "), (None, "no id"), (None, "no id"), (None, None), (7, long), (8, long),
        (9, long + " tail"), (10, passage), (11, "head " + passage), (12, passage + " x " + passage),
        (13, other), (14, " ".join(near)), (15, "x " * 500), (16, "Ünï çödé 北京 \U0001f600 " * 20),
        (17, "A B C d"), (18, "a b c d"), (18, "the same id"), (19, "1234 5678 !!"), (20, "\x1c \x85 \xa0"),
        (21, "line\nline\n\nline\nlast"), (22, "<|endoftext|> [INST] </s> don't stop\n\n\n  now."),
    ]
    texts += [(100 + i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 120)))) for i in range(60)]
    texts += [(200 + i, passage) for i in range(40)]
    sources = [None, "b", "a", "é", ""]
    langs = ["en", None, "fr"]
    return [
        (i, t, langs[k % 3], sources[k % 5], None if t is None else len(t), *["clash"] * len(CLASHES))
        for k, (i, t) in enumerate(texts)
    ]


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def simhash(text: str | None) -> int:
    some = [w.lower() for w in words(text)]
    if not some:
        return 0
    shingles = [b" ".join(some[i : i + 4]) for i in range(max(1, len(some) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps: list[int], bits: int = 4) -> list[int]:
    """The index of the first member of each fingerprint's class."""
    parent = list(range(len(fps)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(fps))]


def without_repeats(texts: list[str | None], size: int = 35) -> list[tuple[int, int, str]]:
    """(n_words, n_removed, kept_sha256) of each text."""
    split = [words(t) for t in texts]
    windows = Counter(
        tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1)
    )
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - size + 1):
            if windows[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def targets(sizes: dict, epochs: int = 3) -> dict:
    """Water-filled targets of sources with weights 1, 2, 3, repeating, null last."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    full: set = set()
    while True:
        rest = sum(sizes.values()) - sum(epochs * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in order if s not in full)
        share = {s: epochs * sizes[s] if s in full else rest * weight[s] / open_weight for s in order}
        above = {s for s in order if s not in full and share[s] > epochs * sizes[s]}
        if not above:
            return share
        full |= above


def one_spaced(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def quality_counts(text: str | None) -> tuple:
    text = text or ""
    some = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(some, some[1:], some[2:], strict=False))
    covered: set[int] = set()
    for i in range(len(some) - 2):
        if grams[tuple(some[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(some), sum(map(len, some)), symbols, len(lines) - len(set(lines)), len(covered)


def group_by(rows, key):
    out = defaultdict(list)
    for row in rows:
        out[key(row)].append(row)
    return out


def runs(words: list[str], min_length: int = 6, min_exponent: int = 4) -> list[tuple[int, int, int]]:
    """All (start, length, smallest period) of maximal periodic stretches, by every period in turn."""
    n, found = len(words), {}
    for period in range(1, n // min_exponent + 1):
        i = 0
        while i + period < n:
            j = i
            while j + period < n and words[j] == words[j + period]:
                j += 1
            if j > i and j + period - i >= max(min_length, min_exponent * period):
                found.setdefault((i, j + period - i), period)
            i = j + 1
    return [(start, length, period) for (start, length), period in sorted(found.items())]


def collapsed(words: list[str], some: list[tuple[int, int, int]]) -> str:
    gone = {i for start, length, period in some for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id: int | None, text: str | None) -> list[str]:
    """The words of a text, made periodic for one id in ten."""
    some = re.findall("[^\\x20\\x09-\\x0D]+", text or "")
    if doc_id is None or not some:
        return some
    h, n = zlib.crc32(str(doc_id).encode()), len(some)
    if h % 10:
        return some
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [some[i] if i < a else some[a + (i - a) % p] for i in range(n)]


def hard_negatives(rows: list[tuple], is_anchor, scale: int = 256) -> set[tuple]:
    """(anchor, positive, rank, negative, scores) over (vec_id, label, vector) rows, pair by pair."""
    held: dict[int, tuple] = {}
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        made = (label, [math.floor(scale * x) for x in vector])
        held[vec_id] = min(held.get(vec_id, made), made)
    out = set()
    for a, (label, vector) in held.items():
        if not is_anchor(a):
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(vector, other, strict=False)), b, of == label)
            for b, (of, other) in held.items()
            if b != a
        )
        for best, positive in [(-s, b) for s, b, same in scored if same][:5]:
            fit = [(b, -s) for s, b, same in scored if not same and 50 * best <= -100 * s <= 95 * best]
            out |= {(a, positive, k, b, best, s) for k, (b, s) in enumerate(fit[:3], 1)}
    return out
