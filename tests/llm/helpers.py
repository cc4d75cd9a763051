"""Brute-force versions and odd inputs for the training-data operators."""

from __future__ import annotations

from collections import Counter, defaultdict
from fractions import Fraction

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, rep long, score double, kept boolean"
LONG = " ".join(f"word{i % 977} plain" for i in range(30_000))
ROWS = [
    (1, None, "en", "a", None, 1, None, 0.5, True), (2, "", None, None, 0, None, 7, None, None),
    (3, "  \t\n", "en", "a", 4, 2, 8, 0.5, False), (4, "The quick brown fox jumps over it", "en", "b", 33, 3, 9, 0.1, True),
    (5, "the quick brown fox jumps over IT", "en", "b", 33, 3, 9, 0.1, True), (6, LONG, "en", None, len(LONG), 4, 1, 1.0, True),
    (7, LONG + " end", "en", "c", 1, 4, 1, 1.0, True), (8, "Zwölf Boxkämpfer jagen Viktor", "de", "c", 29, 4, 1, 1.0, True),
    (8, "Zwölf Boxkämpfer jagen Viktor", "de", "c", 29, 4, 1, 1.0, True), (9, "12 34 !?", None, "c", 8, 4, 1, 1.0, True),
    (None, "The quick brown fox jumps over it", None, "c", 8, 4, 1, 1.0, True), (10, "a\n\nb\n c", "en", "é", 6, 1, 1, 0.0, None),
]


def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def text_of(row) -> str:
    return row["text"] or ""


def shingle_set(text: str | None) -> frozenset:
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def near_components(texts: dict[int, str]) -> dict[int, int]:
    """Smallest id reachable over links of 0.75, comparing all pairs that share a shingle."""
    sets, posted, parent = {i: shingle_set(t) for i, t in texts.items()}, defaultdict(list), {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        for j, n in Counter(j for s in sets[i] for j in posted[s]).items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
        for s in sets[i]:
            posted[s].append(i)
    return {i: find(i) for i in texts}


def mixture_targets(sizes: dict[str | None, int], weights=(3, 1, 2), share=Fraction(3, 2), most=2) -> dict:
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    rest, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        level = rest / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > most * sizes[s]}
        if not over:
            out |= {s: level * weight[s] for s in free}
            break
        for s in over:
            out[s] = Fraction(most * sizes[s])
            rest -= out[s]
        free -= over
    return out
