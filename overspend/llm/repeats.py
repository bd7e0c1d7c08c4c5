"""Exact removal of long repeats by a depth-limited radix sort of suffixes, over bytes.

Suffixes are grouped by their first 400 bytes, most significant digits first; groups that are equal to that depth are exactly the repeated windows. Each
pass is a shuffle on the next digit, and only groups of two or more go on.

First pass: in every window of 400 bytes one place is marked, the one whose 100-byte string has the least hash (the last one of equals). Equal windows mark
the same place, so windows are handled by their marked place: about one in 150 bytes is a row, with the 100-byte digit as its key and
the range of window starts that it stands for. Second pass: starts are taken 16 at a time, and the key is the 385 bytes that their windows share. Third
pass: single starts, to the full 400 bytes. In each pass a range whose windows are all equal to another range's is settled as a whole; one of
the equal ranges goes on as their witness, so copies of any number become one row by partial aggregation. Digits of 100 bytes are compared by 64-bit hashes, as they only
choose candidates; the other keys are 128-bit hashes.

The same passes over words, to a threshold of 51, tell which documents share a passage of over 50 words that may be shorter than 400 bytes: digits of 17 words at
marked places, then whole ranges, then single windows for what is still open.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from overspend.llm.common import MIX_1, RollingHash, map_batches, mix, release, written
from overspend.llm.neardup import word_hashes

LENGTH, DIGIT, GROUP = 400, 100, 16
SPAN = LENGTH - DIGIT + 1
SEGMENT = 1 << 20
ROLLING = RollingHash()
PLACE_BITS = 21
#: Words of a shared passage, and of its first digit.
PASSAGE, PASSAGE_DIGIT = 51, 17
WORD_SEGMENT = 1 << 17
ID = "struct<key:bigint,text:bigint>"


def _runs(hashes: np.ndarray, span: int) -> Iterator[tuple[int, int, int]]:
    """(place of the least hash, first window, last window) of runs of windows of ``span`` hashes that share that place; the last one of equals counts."""
    low = np.uint64((1 << PLACE_BITS) - 1)
    places = np.arange(len(hashes), dtype=np.uint64)
    keys = (hashes & ~low) | (low - places)
    windows = len(hashes) - span + 1
    padded = np.full(-(-len(keys) // span) * span, (1 << 64) - 1, np.uint64)
    padded[:len(keys)] = keys
    blocks = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:windows], ahead[span - 1:span - 1 + windows])
    place = (low - (least & low)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(place)) + 1
    starts = np.concatenate([[0], cuts])
    ends = np.concatenate([cuts - 1, [windows - 1]])
    return zip(place[starts].tolist(), starts.tolist(), ends.tolist())


def marks(data: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(marked place, first start, last start) of all windows, by runs of windows that mark the same place."""
    done = -1
    for base in range(0, max(0, len(data) - LENGTH + 1), SEGMENT - LENGTH + 1):
        part = data[base:base + SEGMENT]
        for p, a, b in _runs(ROLLING.grams(part, DIGIT), SPAN):
            yield base + p, base + a, base + b
        done = base + len(part) - LENGTH
    assert done == max(-1, len(data) - LENGTH)


def word_marks(words: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(digit, marked place, first start, last start) of all windows of ``PASSAGE`` words."""
    for base in range(0, max(0, len(words) - PASSAGE + 1), WORD_SEGMENT - PASSAGE + 1):
        part = words[base:base + WORD_SEGMENT]
        digits = np.zeros(len(part) - PASSAGE_DIGIT + 1, np.uint64)
        for k in range(PASSAGE_DIGIT):
            digits = (digits * MIX_1) + part[k:k + len(digits)]
        digits = mix(digits)
        for p, a, b in _runs(digits, PASSAGE - PASSAGE_DIGIT + 1):
            yield int(digits[p].view(np.int64)), base + p, base + a, base + b


def _word_pass(batches):
    for batch in batches:
        out = {name: [] for name in ("id", "digit", "whole", "low", "high")}
        for key, text in zip(batch["id"], batch["text"]):
            words = word_hashes(text)
            for digit, place, low, high in word_marks(words):
                out["id"].append(key)
                out["digit"].append(digit)
                out["whole"].append(xxhash.xxh3_64_intdigest(words[low:high + PASSAGE].tobytes(), seed=place - low) - (1 << 63))
                out["low"].append(low)
                out["high"].append(high)
        yield out


def _word_windows(batches):
    for batch in batches:
        out = {"id": [], "window": []}
        for key, text, ranges in zip(batch["id"], batch["text"], batch["ranges"]):
            words = word_hashes(text)
            for start in sorted({n for r in ranges for n in range(r["low"], r["high"] + 1)}):
                out["id"].append(key)
                out["window"].append(xxhash.xxh3_128_digest(words[start:start + PASSAGE].tobytes()))
        yield out


def passage_sharers(texts: DataFrame) -> DataFrame:
    """The ids of ``texts`` (id, text) that hold a run of over 50 words which another document has too, A-Z in either case and whatever the blanks.

    Equal ids are copies of one document. A document is settled as soon as one whole range of windows is found in another one; single windows are compared only
    at digits of documents that no range has settled, one row for each class of equal ranges.
    """
    rows = written(map_batches(texts, _word_pass, f"id {ID}, digit long, whole long, low int, high int"), "passages")
    repeated = written(rows.groupBy("digit").agg(F.count("*").alias("n")).where("n > 1").select("digit"), "digits")
    live = written(rows.join(repeated, "digit", "left_semi"), "live")
    twins = texts.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id").join(rows.select("id").distinct(), "id", "left_semi")
    classes = written(live.groupBy("digit", "whole").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.min(F.struct("id", "low", "high")).alias("one")), "classes")
    in_others = live.join(classes.where("least <> most").select("digit", "whole"), ["digit", "whole"], "left_semi").select("id")
    settled = written(in_others.unionByName(twins).distinct(), "settled")
    unsettled = live.join(settled, "id", "left_anti").select("digit").distinct()
    open_ = classes.join(unsettled, "digit", "left_semi").select("one.*").groupBy("id").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    # Copies of a text give the same windows; one of them is enough.
    once = texts.join(open_, "id").groupBy("id").agg(F.first("text").alias("text"), F.first("ranges").alias("ranges"))
    windows = written(map_batches(once.select("id", "text", "ranges"), _word_windows, f"id {ID}, window binary"), "windows")
    both = windows.groupBy("window").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least <> most").select("window")
    sharers = written(windows.join(both, "window", "left_semi").select("id").unionByName(settled).distinct(), "sharers")
    release(rows, repeated, live, classes, settled, windows)
    return sharers


def _first_pass(batches):
    for batch in batches:
        out = {name: [] for name in ("id", "place", "low", "high", "digit", "whole")}
        for key, raw in zip(batch["id"], batch["raw"]):
            for place, low, high in marks(np.frombuffer(raw, np.uint8)):
                out["id"].append(key)
                out["place"].append(place)
                out["low"].append(low)
                out["high"].append(high)
                out["digit"].append(xxhash.xxh3_64_intdigest(raw[place:place + DIGIT]) - (1 << 63))
                out["whole"].append(xxhash.xxh3_128_digest(raw[low:high + LENGTH], seed=place - low))
        yield out


def _second_pass(batches):
    """Starts in groups of 16 by their distance to the marked place, clipped to the range; what exceeds the shared bytes is kept as it is."""
    for batch in batches:
        out = {name: [] for name in ("id", "low", "high", "shared", "left", "right")}
        for key, raw, ranges in zip(batch["id"], batch["raw"], batch["ranges"]):
            for r in ranges:
                for group in range((r["place"] - r["high"]) // GROUP, (r["place"] - r["low"]) // GROUP + 1):
                    top = r["place"] - GROUP * group
                    bottom = top - GROUP + 1
                    low, high = max(bottom, r["low"]), min(top, r["high"])
                    out["id"].append(key)
                    out["low"].append(low)
                    out["high"].append(high)
                    out["shared"].append(xxhash.xxh3_128_digest(raw[top:bottom + LENGTH], seed=group))
                    out["left"].append(raw[low:top])
                    out["right"].append(raw[bottom + LENGTH:high + LENGTH])
        yield out


def _third_pass(batches):
    for batch in batches:
        out = {name: [] for name in ("id", "low", "window")}
        for key, low, high, shared, left, right in zip(*(batch[n] for n in ("id", "low", "high", "shared", "left", "right"))):
            bottom = low + len(left) - GROUP + 1
            for start in range(low, high + 1):
                out["id"].append(key)
                out["low"].append(start)
                end = start - bottom
                out["window"].append(xxhash.xxh3_128_digest(shared + bytes([end]) + left[start - low:] + right[:end]))
        yield out


def _refine(rows: DataFrame, digit: str, rest: list[str], fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """Of ``rows``: (id, low, high) of those equal in ``digit`` and ``rest`` to another; and one row of each class of equals for the next pass, where
    the digit has more than one class. ``rows`` is a written table, whose folder is removed."""
    # Digits that occur once end here. Only their keys move, before the partial sums.
    repeated = written(rows.groupBy(digit).agg(F.count("*").alias("rows")).where("rows > 1").select(digit), "digits")
    live = written(rows.join(repeated, digit, "left_semi"), "live")
    release(rows, repeated)
    classes = written(live.groupBy(digit, *rest).agg(F.count("*").alias("rows"), F.min(F.struct(*fields)).alias("one")), "classes")
    settled = written(live.join(classes.where("rows > 1").select(digit, *rest), [digit, *rest], "left_semi").select("id", "low", "high"), "settled")
    release(live)
    several = written(classes.groupBy(digit).agg(F.count("*").alias("classes")).where("classes > 1").select(digit), "digits")
    return settled, classes.join(several, digit, "left_semi").select(digit, *rest, "one.*")


def repeated_ranges(raw: DataFrame) -> DataFrame:
    """(id, ranges) of the texts ``raw`` (id, raw): ranges (low, high) of starts of 400-byte windows that also start elsewhere."""
    spots = map_batches(raw.where(F.length("raw") >= LENGTH), _first_pass, f"id {ID}, place int, low int, high int, digit long, whole binary")
    settled, open_ = _refine(written(spots, "suffixes"), "digit", ["whole"], ["id", "place", "low", "high"])

    wanted = open_.groupBy("id").agg(F.collect_list(F.struct("place", "low", "high")).alias("ranges"))
    groups = map_batches(raw.join(wanted, "id").select("id", "raw", "ranges"), _second_pass, f"id {ID}, low int, high int, shared binary, left binary, right binary")
    more, open_ = _refine(written(groups, "groups"), "shared", ["left", "right"], ["id", "low", "high"])

    single = written(map_batches(open_.select("id", "low", "high", "shared", "left", "right"), _third_pass, f"id {ID}, low int, window binary"), "windows")
    twice = written(single.groupBy("window").agg(F.count("*").alias("rows")).where("rows > 1").select("window"), "digits")
    last = single.join(twice, "window", "left_semi").select("id", "low", F.col("low").alias("high"))
    return settled.unionByName(more).unionByName(last).groupBy("id").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))


def spans(ranges) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by windows that start in ``ranges``."""
    out: list[list[int]] = []
    for low, high in sorted((r["low"], r["high"]) for r in ranges or []):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high + LENGTH)
        else:
            out.append([low, high + LENGTH])
    return [(a, b) for a, b in out]


def _kept(raw: bytes, removed: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for start, end in removed:
        parts.append(raw[at:start])
        at = end
    return b"".join([*parts, raw[at:]])


def remove_repeats(df: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, spans, kept, n_bytes, shares_passage) per row: byte spans that are removed, the remaining bytes, and whether a run of over 50 words, of any
    length in bytes, is in another document too.

    A null text is empty; texts under 400 bytes never match. Equal rows count as copies of each other. Rows are told apart by key and text, so a
    key that is null or repeats with another text is fine.
    """
    text = F.coalesce(F.col(column), F.lit(""))
    raw = df.select(F.struct(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("text")).alias("id"), text.cast("binary").alias("raw"))

    def run(batches):
        for batch in batches:
            out = {"key": batch["key"], "n_bytes": [], "spans": [], "kept": [], "shares_passage": batch["shares"]}
            for one, ranges in zip(batch["raw"], batch["ranges"]):
                removed = spans(ranges)
                out["n_bytes"].append(len(one))
                out["spans"].append([{"start": a, "end": b} for a, b in removed])
                out["kept"].append(_kept(one, removed))
            yield out

    sharers = passage_sharers(raw.where(F.length("raw") > 0).select("id", F.col("raw").cast("string").alias("text")))
    known = repeated_ranges(raw).join(sharers.withColumn("shares", F.lit(True)), "id", "full")
    joined = raw.join(known, "id", "left").select(F.col("id.key").alias("key"), "raw", "ranges", F.coalesce("shares", F.lit(False)).alias("shares"))
    return map_batches(joined, run, "key long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary, shares_passage boolean").withColumnRenamed("key", key)


def digest(df: DataFrame, key: str = "doc_id") -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + (s["end"] - s["start"]))
    return df.select(key, "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
                     "shares_passage")


def sha256_hex(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()
