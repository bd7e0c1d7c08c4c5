"""Token counts of the sections of a document.

A document is encoded once, as a whole, since tokens at a border depend on both sides. Token lengths give their spans in bytes, and counting the bytes
that begin a character gives spans in code points. Sections are sorted spans, so tokens and sections are joined by binary search. A token that
crosses a border is allocated by rule: ``first`` gives it to the section of its first character, ``largest`` to the one that holds
most of its characters, the earlier one if equal. A token that holds only later bytes of a character counts as standing at that character.
Text outside of all sections has the section number -1.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from overspend.llm.bpe import encoder
from overspend.llm.common import map_batches


def token_spans(raw: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last character, both inclusive, of tokens of ``lengths`` bytes."""
    characters = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) - 1
    ends = np.cumsum(lengths)
    return characters[ends - lengths], characters[ends - 1]


def allocate(first: np.ndarray, last: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token, and whether it crosses a border. Sections are sorted and do not overlap."""
    # Borders cut the text into stretches; a stretch is a section or a gap.
    left = np.searchsorted(starts, first, "right") - 1
    right = np.searchsorted(starts, last, "right") - 1

    def holder(place: np.ndarray, section: np.ndarray) -> np.ndarray:
        return np.where((section >= 0) & (place < np.append(ends, 0)[section]), section, -1)

    own, other = holder(first, left), holder(last, right)
    crossing = (own != other) | (left != right)
    if rule == "first" or not crossing.any():
        return own, crossing
    for i in np.flatnonzero(crossing):
        held: dict[int, int] = {}
        for place in range(first[i], last[i] + 1):
            s = int(np.searchsorted(starts, place, "right")) - 1
            s = s if s >= 0 and place < ends[s] else -1
            held[s] = held.get(s, 0) + 1
        own[i] = max(held, key=lambda s: held[s])
    return own, crossing


def line_sections(text: str) -> list[tuple[int, int]]:
    """Lines as sections; the line end belongs to the line it closes."""
    out, at = [], 0
    for line in text.split("\n"):
        out.append((at, min(at + len(line) + 1, len(text))))
        at += len(line) + 1
    return [(a, b) for a, b in out if b > a]


def attribute(df: DataFrame, path: str, pattern: str, key: str = "doc_id", column: str = "text", sections: str | None = None, rule: str = "first") -> DataFrame:
    """(key, section, start, end, n_tokens, n_crossing) for each section of each row.

    ``sections`` names a column of sorted, disjoint (start, end) structs in code points; without it lines are the sections. ``n_crossing`` counts the
    section's tokens that cross a border. A null or empty text has one section of no tokens, number 0 from 0 to 0; text outside of sections is
    reported as section -1 if it has tokens. Repeated rows are reported each.
    """
    def run(batches):
        code = encoder(path, pattern)
        sizes = np.array([len(token) for token in code.tokens], np.int64)
        for batch in batches:
            out = {name: [] for name in ("key", "section", "start", "end", "n_tokens", "n_crossing")}
            for row, (one, text) in enumerate(zip(batch["key"], batch["text"])):
                text = text or ""
                given = [(s["start"], s["end"]) for s in batch["sections"][row] or []] if sections else line_sections(text)
                ids = np.array(code.encode(text), np.int64)
                bounds = np.array(given or [(0, 0)], np.int64)
                if len(ids):
                    first, last = token_spans(text.encode("utf-8"), sizes[ids])
                    section, crossing = allocate(first, last, bounds[:, 0], bounds[:, 1], rule)
                else:
                    section, crossing = np.empty(0, np.int64), np.empty(0, bool)
                counts = np.bincount(section + 1, minlength=len(bounds) + 1)
                crossed = np.bincount(section + 1, weights=crossing, minlength=len(bounds) + 1).astype(np.int64)
                numbers = range(-1 if counts[0] else 0, len(bounds))
                out["key"] += [one] * len(numbers)
                out["section"] += numbers
                out["start"] += [int(bounds[n, 0]) if n >= 0 else None for n in numbers]
                out["end"] += [int(bounds[n, 1]) if n >= 0 else None for n in numbers]
                out["n_tokens"] += [int(counts[n + 1]) for n in numbers]
                out["n_crossing"] += [int(crossed[n + 1]) for n in numbers]
            yield out

    columns = [F.col(key).alias("key"), F.col(column).alias("text"), *([F.col(sections).alias("sections")] if sections else [])]
    rows = df.select(*columns)
    kind = rows.schema["key"].dataType.simpleString()
    return map_batches(rows, run, f"key {kind}, section int, start int, end int, n_tokens long, n_crossing long").withColumnRenamed("key", key)
