"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are lower-cased and runs of blanks become one space. An item longer than ``PIECE`` characters is cut into overlapping pieces, so that
a leaked part counts too. A piece of m characters with at most k edits shares at least m + 1 - q(k + 1) of its q-grams with the place in the text, all within
k + 1 neighbouring diagonals (text position less piece position). Shared q-grams are counted in bands of diagonals that overlap by the edit
budget, so the right place lies inside one band; bands that reach the bound are aligned within the band. A piece matches with at most k edits; k is a
tenth of its length, or as many as leave the bound at 1 for short ones. Items of fewer than q characters have no q-gram; they are searched
exactly, as whole words.

The benchmark is the stated query set: it is sent to the tasks in blocks of bounded size, and every block meets all rows. Counting uses a
symbol of one byte per character, which equal characters share, so no match is lost; alignment compares the characters themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame, functions as F

from overspend.llm.common import map_batches

Q, PIECE, SHIFT, RATE = 8, 160, 80, 0.1
BAND = 32
#: Characters of benchmark text that go to the tasks at once.
BLOCK_CHARS = 4_000_000
#: Characters of a text that are searched at once; neighbouring windows overlap by more than a piece.
WINDOW = 1 << 19
TABLE_BITS = 23
#: Pairs that are aligned together.
TOGETHER = 1024


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(text: str) -> list[str]:
    """Overlapping parts that cover the whole normalised item; an item shorter than q has none and is searched as it is."""
    text = normal(text)
    if len(text) <= PIECE:
        return [text] if len(text) >= Q else []
    starts = list(range(0, len(text) - PIECE, SHIFT)) + [len(text) - PIECE]
    return [text[s:s + PIECE] for s in starts]


def budget(size: int) -> int:
    """Edits allowed in a piece of ``size`` characters, such that the lemma still asks for one shared q-gram."""
    return max(0, min(int(size * RATE), (size + 1 - 1) // Q - 1))


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(codes: np.ndarray) -> np.ndarray:
    """Every q-gram of one-byte symbols as a number."""
    symbols = (codes ^ (codes >> np.uint32(8)) ^ (codes >> np.uint32(16))).astype(np.uint8)
    if len(symbols) < Q:
        return np.empty(0, np.uint64)
    return np.ndarray((len(symbols) - Q + 1,), "<u8", symbols.tobytes(), strides=(1,)).astype(np.uint64)


def _slots(keys: np.ndarray) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.intp)


class ShortItems:
    """Items of fewer than q characters. They match exactly and as whole words: no letter or digit touches a letter or digit at their ends."""

    def __init__(self) -> None:
        self.owners: dict[str, list[int]] = {}
        self.automaton = ahocorasick.Automaton()

    def add(self, item: int, text: str) -> None:
        if 0 < len(text) < Q:
            self.owners.setdefault(text, []).append(item)

    def close(self) -> None:
        for text in self.owners:
            self.automaton.add_word(text, text)
        self.automaton.make_automaton()

    def places(self, text: str) -> dict[int, int]:
        """The first place of each item in the normalised text."""
        found: dict[int, int] = {}
        if not self.owners:
            return found
        for last, word in self.automaton.iter(text):
            start, end = last + 1 - len(word), last + 1
            if start and word[0].isalnum() and text[start - 1].isalnum() or end < len(text) and word[-1].isalnum() and text[end].isalnum():
                continue
            for item in self.owners[word]:
                found.setdefault(item, start)
        return found


class Index:
    """The q-grams of all pieces of a block of items."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.items, self.pieces, self.short = [], [], ShortItems()
        keys, owners, offsets = [], [], []
        for item, text in items:
            self.short.add(item, normal(text))
            for piece in pieces(text):
                found = grams(codes := points(piece))
                keys.append(found)
                owners.append(np.full(len(found), len(self.pieces)))
                offsets.append(np.arange(len(found)))
                self.items.append(item)
                self.pieces.append(codes)
        size = np.array([len(p) for p in self.pieces], np.int64)
        self.edits = np.array([budget(n) for n in size], np.int64)
        self.bound = size + 1 - Q * (self.edits + 1)
        keys = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, first = np.unique(keys[order], return_index=True)
        self.first = np.append(first, len(keys))
        self.owners = (np.concatenate(owners) if owners else np.empty(0, np.int64))[order]
        self.offsets = (np.concatenate(offsets) if offsets else np.empty(0, np.int64))[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[_slots(self.keys)] = True
        self.short.close()

    def _regions(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """(piece, first diagonal of the band) of bands that reach the bound."""
        found = grams(codes)
        places = np.flatnonzero(self.table[_slots(found)])
        at = np.searchsorted(self.keys, found[places])
        real = at < len(self.keys)
        real[real] = self.keys[at[real]] == found[places[real]]
        places, at = places[real], at[real]
        counts = self.first[at + 1] - self.first[at]
        ends = np.cumsum(counts)
        rows = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts) + np.repeat(self.first[at], counts)
        piece = self.owners[rows]
        diagonal = np.repeat(places, counts) - self.offsets[rows] + PIECE
        band = diagonal // BAND
        before = diagonal - band * BAND <= self.edits[piece]
        both = np.concatenate([band, band[before] - 1]) * len(self.pieces) + np.concatenate([piece, piece[before]])
        keys, shared = np.unique(both, return_counts=True)
        for key in keys[shared >= self.bound[keys % max(1, len(self.pieces))]]:
            yield int(key % len(self.pieces)), int(key // len(self.pieces)) * BAND - PIECE

    def matches(self, texts: list[str | None]) -> list[dict[int, tuple[int, int, int]]]:
        """For each text and each item found in it: number of the item's pieces that match, edits of the best one, and the earliest start of a band."""
        step, most = WINDOW - 4 * PIECE, int(self.edits.max(initial=0))
        found: list[dict[int, dict[int, tuple[int, int]]]] = [{} for _ in texts]
        waiting: list[tuple[int, int, int, np.ndarray]] = []

        def settle() -> None:
            waiting.sort(key=lambda w: len(self.pieces[w[1]]))
            limits = self.edits[[w[1] for w in waiting]]
            for (row, piece, start, _), edits, limit in zip(waiting, aligned([self.pieces[w[1]] for w in waiting], [w[3] for w in waiting], limits, BAND + 3 * most + 1), limits):
                known = found[row].setdefault(self.items[piece], {})
                if edits <= limit and edits < known.get(piece, (1 << 30, 0))[0]:
                    known[piece] = int(edits), start
            waiting.clear()

        exact = []
        for row, text in enumerate(texts):
            text = normal(text)
            exact.append(self.short.places(text))
            codes = points(text)
            for offset in range(0, max(1, len(codes) - 4 * PIECE), step):
                window = codes[offset:offset + WINDOW]
                for piece, low in self._regions(window):
                    waiting.append((row, piece, offset + max(0, low), _region(window, low - most, BAND + 3 * most + 1 + len(self.pieces[piece]))))
                    if len(waiting) >= TOGETHER:
                        settle()
        if waiting:
            settle()
        return [{item: (1, 0, start) for item, start in places.items()}
                | {item: (len(best), min(e for e, _ in best.values()), min(s for _, s in best.values())) for item, best in one.items() if best}
                for places, one in zip(exact, found)]


def _region(text: np.ndarray, start: int, length: int) -> np.ndarray:
    """``length`` characters from ``start`` on; places outside of the text hold a number that is no character."""
    out = np.full(length, 0xFFFFFFFF, np.uint32)
    a, b = max(0, start), min(len(text), start + length)
    if a < b:
        out[a - start:b - start] = text[a:b]
    return out


def aligned(pieces: list[np.ndarray], regions: list[np.ndarray], limits: np.ndarray, width: int) -> np.ndarray:
    """Fewest edits that turn each piece into a part of its region, on ``width`` diagonals from the region's start; some number above the limit
    if there are more. All pairs advance together, one piece character at a time, and leave when they exceed their limit.

    Cells are (piece position i, diagonal d), the place in the region is i + d. The start and the end in the region are free. A row follows from the one
    before it by substitution (same diagonal) and deletion (next higher diagonal); insertions run along the row as a running minimum. A place outside of the text
    matches nothing, so using it costs as much as a deletion.
    """
    sizes = np.array([len(p) for p in pieces])
    longest = int(sizes.max())
    letters = np.full((len(pieces), longest), 0xFFFFFFFE, np.uint32)
    places = np.full((len(pieces), longest + width), 0xFFFFFFFF, np.uint32)
    for k, (piece, region) in enumerate(zip(pieces, regions)):
        letters[k, :len(piece)] = piece
        places[k, :len(region)] = region
    result = limits + 1
    alive, span = np.arange(len(pieces)), np.arange(width, dtype=np.int32)
    row = np.zeros((len(pieces), width), np.int32)
    for i in range(longest):
        step = row + (places[alive, i:i + width] != letters[alive, i:i + 1])
        np.minimum(step[:, :-1], row[:, 1:] + 1, out=step[:, :-1])
        row = np.minimum.accumulate(step - span, axis=1) + span
        best = row.min(axis=1)
        ended = sizes[alive] == i + 1
        result[alive[ended]] = best[ended]
        stay = ~ended & (best <= limits[alive])
        if not stay.all():
            alive, row = alive[stay], row[stay]
            if not len(alive):
                break
    return result


def _blocks(benchmark: DataFrame, item: str, column: str) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, each item once; null items are left out."""
    rows = benchmark.where(F.col(item).isNotNull() & F.col(column).isNotNull()).select(F.col(item).cast("long"), column).distinct().orderBy(item, column)
    block, size = [], 0
    for key, text in rows.toLocalIterator():
        block.append((key, text))
        size += len(text)
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def leaks(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", column: str = "text", item: str = "item_id", item_column: str = "text") -> DataFrame:
    """(key, item, n_pieces, edits, start) for each row and benchmark item of which it holds a piece; ``start`` is a place in the normalised text.

    Null and empty texts hold nothing. Repeated rows give repeated matches, repeated items count once; without items there are no matches.
    """
    rows = df.select(F.col(key).alias("key"), F.col(column).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, item long, n_pieces long, edits long, start long"
    found = None
    for block in _blocks(benchmark, item, item_column):
        sent = df.sparkSession.sparkContext.broadcast(block)

        def run(batches, sent=sent):
            index = Index(sent.value)
            for batch in batches:
                hits = [(one, doc, *match) for one, found in zip(batch["key"], index.matches(batch["text"])) for doc, match in sorted(found.items())]
                yield {name: [hit[i] for hit in hits] for i, name in enumerate(("key", "item", "n_pieces", "edits", "start"))}

        part = map_batches(rows, run, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = df.sparkSession.createDataFrame([], schema)
    # An item may be split over two rows of the benchmark that share an id.
    return (found.groupBy("key", "item").agg(F.sum("n_pieces").alias("n_pieces"), F.min("edits").alias("edits"), F.min("start").alias("start"))
            .withColumnsRenamed({"key": key, "item": item}))


def without_leaks(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """The rows that hold no piece of any item, all columns as they were. Each row is judged by its own text, whatever its key: rows without a key and rows that
    repeat one are separate documents. A null text holds nothing."""
    texts = df.where(F.col(column).isNotNull()).select(F.md5(F.col(column).cast("binary")).alias("doc_id"), F.col(column).alias("text"))
    bad = leaks(texts, benchmark).select(F.col("doc_id").alias("_bad")).distinct()
    return df.join(bad, F.md5(df[column].cast("binary")) == F.col("_bad"), "left_anti")
