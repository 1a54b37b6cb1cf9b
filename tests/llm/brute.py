"""Plain versions of the operators for small tables, and rows that try their edges."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that the operators use inside.
CLASHES = ["digest", "fp", "print", "places", "result", "score", "lang_pred", "start", "spans", "rows", "hit_id", "own_id", "window"]


def sentence(rng, words: int, kind: str = "en") -> str:
    parts = {"en": ["th", "er", "on", "ing", "ed", "at"], "de": ["sch", "ung", "ö", "keit", "ver", "ß"], "fr": ["eau", "é", "oi", "ç", "ment", "que"]}
    return " ".join("".join(rng.choice(parts[kind]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def edge_docs(rng) -> list[tuple]:
    long = sentence(rng, 30_000)
    copy = sentence(rng, 120)
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n", None, None, None),
        (4, "12 345 %%%", "de", "a", 10),
        (5, long, "en", "a", len(long)),
        (6, copy, "en", "b", 1),
        (7, copy, "en", "b", 1),
        (8, copy.upper(), "en", "b", 1),
        (8, copy.upper(), "en", "b", 1),
        (9, "one", "en", None, 3),
        (10, "two words", "en", "b", 9),
        (11, "日本語 😀 Ünïcode É ▁ \x00 x", "fr", "b", 1),
        (None, sentence(rng, 50), "en", "b", 1),
        (None, None, None, None, None),
        (-5, copy + " " + sentence(rng, 3), "en", "b", 1),
    ]
    for k, kind in enumerate(["en", "de", "fr"] * 12):
        text = sentence(rng, rng.randint(1, 200), kind)
        rows.append((100 + k, text, kind, f"s{k % 4}", len(text)))
    return rows


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES])


def simhash_of(text: str | None, words: int = 3) -> int:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    tokens = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(tokens[i : i + words]) for i in range(len(tokens) - words + 1)] or ([" ".join(tokens)] if tokens else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: list[int], distance: int = 3) -> list[int]:
    """For each print the smallest place of its component."""
    root = list(range(len(prints)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contamination(text: str | None, items: list[tuple]) -> tuple[int, set[int], set[str]]:
    """Words, places of hit words, items that hit."""
    words, hit, found = words_of(text), set(), set()
    for item, body in items:
        w = words_of(body)
        n = min(10, len(w))
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in grams:
                hit.update(range(i, i + n))
                if item is not None:
                    found.add(str(item))
    return len(words), hit, found


def marginals(emission: np.ndarray, switch: np.ndarray) -> np.ndarray:
    """Word by word forward-backward, in logarithms."""
    n, k = emission.shape
    forward, backward = np.zeros((n, k)), np.zeros((n, k))
    before = np.full(k, -np.log(k))
    for t in range(n):
        before = forward[t] = emission[t] + np.logaddexp.reduce(before[:, None] + switch, axis=0)
    for t in range(n - 2, -1, -1):
        backward[t] = np.logaddexp.reduce(switch + emission[t + 1] + backward[t + 1], axis=1)
    both = forward + backward
    return np.exp(both - np.logaddexp.reduce(both, axis=1)[:, None])


def repeats(texts: dict, cut, digests, passages, min_words: int, reach: int) -> dict:
    """``{id: (passages, spans to cut, ids that keep them)}`` for texts of different ids."""
    found = {i: digests((t or "").encode(), cut((t or "").encode(), reach)).tolist() for i, t in texts.items()}
    count = Counter(d for ds in found.values() for d in ds)
    first: dict = {}
    for i in sorted(found):
        for place, d in enumerate(found[i]):
            first.setdefault(d, (i, place))
    out = {}
    for i, t in texts.items():
        places = [
            {"place": k, "extra": first[d] != (i, k), "first_id": first[d][0]} for k, d in enumerate(found[i]) if count[d] > 1
        ]
        out[i] = passages((t or "").encode(), places, min_words, reach) if places else ([], [], set())
    return out
