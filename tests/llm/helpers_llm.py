"""Edge rows and brute-force versions."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rows long, key string, kept string, id string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, lang, src, None if t is None else len(t), 1, "k", "x", "y") for i, t, lang, src in rows], SCHEMA)


def edge_rows():
    """Nulls in any column, empty and blank texts, a very long text, repeated rows, ties."""
    random.seed(5)
    vocabulary = ["alpha", "beta", "gamma", "Delta", "épée", "日本", "x", "token", "=", "12.5", "a@b.c"]
    long_text = " ".join(random.choice(vocabulary) for _ in range(60_000))
    return [(1, None, "en", "s"), (2, "", None, "s"), (3, " \t\n", "en", None), (4, "one", "en", "s"), (5, "one", "en", "s"), (6, "one two three", "en", "s"),
            (7, long_text, "en", "s"), (8, long_text, "en", "s"), (9, long_text + " end", "de", "s"), (None, "a row without an id", "en", "s"),
            (10, "twice the same row", "en", "s"), (10, "twice the same row", "en", "s"), (11, "x" * 70_000, "en", "s"), (12, "\x00\x0b é   \U0001F600", "en", "s")]


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingle_set(text, size):
    found = words(lower(text))
    return {tuple(found[i:i + size]) for i in range(len(found) - size + 1)} if len(found) >= size else ({tuple(found)} if found else set())


def groups(rows, size, percent):
    """(id, set size, component) of all documents by comparing all pairs."""
    sets = {i: shingle_set(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}
