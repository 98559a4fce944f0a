"""Small tables for the tests of tokenmill.llm, and plain-Python models."""

from __future__ import annotations

import collections
import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, score double, sid long, key binary"


def words(rng: random.Random, n: int, vocab: int = 3000) -> list[str]:
    return [f"w{rng.randrange(vocab):x}" for _ in range(n)]


def frame(spark, texts, first_id: int = 0, ids=None):
    """Documents with extra columns whose names operators use themselves."""
    ids = list(range(first_id, first_id + len(texts))) if ids is None else ids
    rows = [(i, t, None, "s", None if t is None else len(t), "x", None, 7, None) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def odd_texts() -> list[str | None]:
    """Nulls, empty and blank texts, a very long one, copies and near copies."""
    rng = random.Random(5)
    base = words(rng, 120)
    near = []
    for _ in range(45):  # more near copies than a listed group may hold
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        near.append(" ".join(w))
    passage = " ".join(words(rng, 60))
    shared = [" ".join(words(rng, 90)) + " " + passage + " " + " ".join(words(rng, 60)) for _ in range(40)]
    small = []
    for n in range(1, 30):  # small sets: one word changed at the end
        w = words(rng, n)
        small += [" ".join(w), " ".join([*w[:-1], "other"]), " ".join([*w, "more"])]
    mid = []
    for n in (40, 63, 64, 65, 130, 300):
        w = words(rng, n)
        mid += [" ".join(w), " ".join(w[: n - n // 9]), " ".join(w[n // 5:]), " ".join(w[::-1])]
    return [None, "", " \t\n ", None, "a", "A", "a b c d", " ".join(words(rng, 20_000)),
            *near, *near[:3], *shared, *small, *mid, "É é ß \x1c x y", "tail   spaces   "]


def shingles(text: str | None) -> frozenset:
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def linked(sets: list[frozenset], pct: int = 75) -> list[int]:
    """Smallest position of the component of every set, by comparing all pairs that share a shingle."""
    root = list(range(len(sets)))

    def find(a):
        while root[a] != a:
            root[a] = a = root[root[a]]
        return a

    at = collections.defaultdict(list)
    for i, s in enumerate(sets):
        shared = collections.Counter(j for x in s for j in at[x])
        for j, n in shared.items():
            if 100 * n >= pct * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for x in s:
            at[x].append(i)
    return [find(i) for i in range(len(sets))]
