"""Byte-level BPE: ids of texts and texts of ids.

Encoding of one piece walks over its bytes once: an Aho-Corasick automaton over the vocabulary, whose byte strings are mapped to
Latin-1, gives the longest token that starts at each place; a token is accepted if it goes together with the one
before it, that is if merging the bytes of both gives just these two; otherwise shorter prefixes are tried, and then the last
accepted token is taken back. Places known to be dead ends are marked, so each is left once. Which pairs of tokens go together
is memorised. A sequence in which all neighbours go together is the result of the merges in rank order.
Pieces that occur often are looked up: words of a text repeat, so a bounded store of pieces serves most of them. Stores have two generations: when the
young one is full it becomes the old one, whose entries come back when they are used again, so frequent entries outlive rare ones.
"""

from __future__ import annotations

import base64
import hashlib
from functools import cache

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame, functions as F

from overspend.llm.common import map_batches

#: What the tokenizer's library takes as white space; \s of the regex package has four control characters more.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Entries of a generation. A piece of at most 64 characters and its ids take about 300 bytes, a pair about 100.
STORED_PIECES, STORED_PAIRS = 200_000, 300_000


def same_spaces(pattern: str) -> str:
    """The pattern with white space spelled out."""
    return pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The merges in rank order, step by step; for short strings."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 60:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Encoder:
    """Encodes pieces and whole texts with the ranks of one vocabulary file."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks = read_ranks(path)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.find = regex.compile(same_spaces(pattern)).findall
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in self.ranks.items():
            self.automaton.add_word(token[::-1].decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.sizes = [len(token) for token in self.tokens]
        self.shorter: dict[int, int] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.old_pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.old_pieces: dict[str, tuple[int, ...]] = {}

    def _prefix(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``; -1 without one."""
        if (found := self.shorter.get(token)) is None:
            text = self.tokens[token]
            found = next((self.ranks[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.ranks), -1)
            self.shorter[token] = found
        return found

    def _together(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens gives just these two; for pairs that the young store does not know."""
        known = self.old_pairs.get((left, right))
        if known is None:
            a, b = self.tokens[left], self.tokens[right]
            known = merge(a + b, self.ranks) == [a, b]
        if len(self.pairs) >= STORED_PAIRS:
            self.pairs, self.old_pairs = {}, self.pairs
        self.pairs[left, right] = known
        return known

    def _longest(self, piece: bytes) -> list[int]:
        """The longest token from each place on. The automaton holds reversed tokens and reads the piece backwards, so that the
        longest match that ends at a character, which it reports first, is the longest token that starts there."""
        last, found = len(piece) - 1, [-1] * len(piece)
        for end, rank in self.automaton.iter(piece[::-1].decode("latin-1")):
            if found[last - end] < 0:
                found[last - end] = rank
        return found

    def encode_piece(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        longest, sizes, size = self._longest(piece), self.sizes, len(piece)
        alive = bytearray(b"\1") * (size + 1)
        ids: list[int] = []
        at, token, before = 0, longest[0], -1
        while at < size:
            while token >= 0:
                end = at + sizes[token]
                if alive[end]:
                    if before < 0:
                        break
                    known = self.pairs.get((before, token))
                    if known or (known is None and self._together(before, token)):
                        break
                token = self._prefix(token)
            if token >= 0:
                ids.append(token)
                at, before = end, token
                token = longest[at] if at < size else -1
            else:
                alive[at] = 0
                token = ids.pop()
                before = ids[-1] if ids else -1
                at -= sizes[token]
        return ids

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        pieces, add = self.pieces, ids.extend
        for piece in self.find(text):
            known = pieces.get(piece)
            if known is None:
                known = self.old_pieces.get(piece) or tuple(self.encode_piece(piece.encode("utf-8")))
                if len(piece) <= 64:
                    if len(pieces) >= STORED_PIECES:
                        self.pieces, self.old_pieces = {}, pieces
                        pieces = self.pieces
                    pieces[piece] = known
            add(known)
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@cache
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per worker process."""
    return Encoder(path, pattern)


def encode(df: DataFrame, path: str, pattern: str, column: str = "text", ids: str = "ids", check: bool = False) -> DataFrame:
    """Add the ids of each text; a null text counts as empty. ``path`` must be readable on every worker.

    With ``check`` the ids are decoded at once, in the same worker, and a difference to the text is an error.
    """
    def coded(code: Encoder, text: str) -> np.ndarray:
        found = code.encode(text)
        if check and code.decode(found) != text.encode("utf-8"):
            raise ValueError("decoded bytes differ")
        return np.array(found, np.int32)

    def run(batches):
        code = encoder(path, pattern)
        for batch in batches:
            yield batch | {ids: [coded(code, text or "") for text in batch[column]]}

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != ids)
    return map_batches(df.drop(ids), run, f"{schema}, `{ids}` array<int>")


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """Add the bytes that the ids stand for; null ids count as none."""
    def run(batches):
        code = encoder(path, pattern)
        for batch in batches:
            yield batch | {column: [code.decode(one or []) for one in batch[ids]]}

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != column)
    return map_batches(df.drop(column), run, f"{schema}, `{column}` binary")


def round_trip(df: DataFrame, path: str, pattern: str, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of each row: ids as little-endian 32-bit numbers, and the bytes decoded from them.

    Encodes and decodes in one pass, so neither ids nor bytes are written. Null and empty texts have no tokens; repeated rows
    give repeated rows; a null key stays null.
    """
    def run(batches):
        code = encoder(path, pattern)
        for batch in batches:
            out = {"key": batch["key"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for text in batch["text"]:
                ids = code.encode(text or "")
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(code.decode(ids)).hexdigest())
            yield out

    rows = df.select(F.col(key).alias("key"), F.col(column).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return map_batches(rows, run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", key)
