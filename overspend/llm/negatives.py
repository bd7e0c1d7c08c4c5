"""Hard negatives by threshold joins over an inverted index of the anchors.

Anchors come to the tasks in blocks of a bounded number of components; all rows pass each block. Dimensions are taken in bands, those of the
greatest energy first. The index lists, for each band, the anchors that need it: from the band on where an anchor's remaining norm times the
greatest remaining norm of any row is below its threshold, the rest of the anchor is left out, since two vectors that meet there only
cannot reach the threshold. Scores are accumulated band by band; a pair goes on only while its partial score plus the product of both
remaining norms can reach the threshold, and what is left of a survivor is computed exactly, left-out dimensions included.

A join starts with high thresholds. Anchors whose windows it does not fill are joined again with lower ones, at last without any, so
every window is complete. A task keeps at most as many rows per window as the window holds, however many rows share a score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from overspend.llm.common import written
from overspend.llm.vectors import EXACT, map_arrow, matrix, numbered, slices
from overspend.session import shared_dir

BAND = 8
#: Components of the anchors of one block, and pairs of a row and an anchor that a task holds at once.
BLOCK, PAIRS = 1 << 20, 1 << 21
#: Thresholds for partners, as shares of the greatest score that the norms allow; then none.
PARTNER_SHARES = (0.8, 0.5, 0.25, None)
#: Thresholds for negatives, between the positive's score and the lower end of the window.
NEGATIVE_STEPS = (0.5, 0.0)
LAST = np.iinfo(np.int64).max

RESULT = "anchor long, anchor_id long, place int, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass
class Shape:
    """What the index needs to know of all rows: order of the dimensions, greatest size in each, greatest norm."""

    order: np.ndarray
    tops: np.ndarray
    norm: float

    @classmethod
    def of(cls, rows: DataFrame) -> Shape:
        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                column = batch.column(0)
                width = int(np.max(np.asarray(column.value_lengths()), initial=0))
                x = matrix(column, width).astype(np.float64)
                squares = (x * x).sum(1).max(initial=0.0)
                yield {"d": [-1, *range(width)], "energy": [0.0, *(x * x).sum(0)], "top": [squares, *np.abs(x).max(0, initial=0.0)]}

        found = map_arrow(rows.select("x"), measure, "d int, energy double, top double").groupBy("d").agg(
            F.sum("energy").alias("energy"), F.max("top").alias("top")).orderBy("d").collect()
        energy, tops = (np.array([row[name] for row in found if row.d >= 0]) for name in ("energy", "top"))
        order = np.argsort(-energy, kind="stable")
        return cls(order, tops[order], math.sqrt(found[0].top) if found else 0.0)


def _rest_norms(x: np.ndarray) -> np.ndarray:
    """For each row and band, the norm from that band on; 0 after the last one. Rounded up."""
    bands = -(-x.shape[1] // BAND)
    padded = np.zeros((len(x), bands * BAND))
    padded[:, :x.shape[1]] = x
    squares = (padded * padded).reshape(len(x), bands, BAND).sum(2)
    rest = np.zeros((len(x), bands + 1))
    rest[:, :bands] = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(rest) * (1 + 1e-9)


class Index:
    """Anchors with a threshold each; ``matches`` gives all pairs of a row and an anchor that reach it."""

    def __init__(self, vectors: np.ndarray, thresholds: np.ndarray, shape: Shape) -> None:
        q = vectors[:, shape.order].astype(np.float64)
        rest, bands = _rest_norms(q), -(-q.shape[1] // BAND)
        reach = np.minimum(shape.norm, [math.sqrt((shape.tops[b * BAND:] ** 2).sum()) for b in range(bands + 1)]) * (1 + 1e-9)
        if (rest[:, 0].max(initial=0.0) * shape.norm) >= EXACT:
            raise ValueError("components are too large for exact scores")
        # Bands that an anchor must be indexed under; the longest first, so that each band's list is a prefix.
        needed = (rest * reach >= thresholds[:, None]) & (np.arange(bands + 1) < bands)
        depth = needed.sum(1)
        self.rows = np.argsort(-depth, kind="stable")
        self.lists = [int((depth > b).sum()) for b in range(bands)]
        self.q, self.rest, self.thresholds = q[self.rows], rest[self.rows], thresholds[self.rows]
        self.order, self.depth = shape.order, depth[self.rows]

    def matches(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, anchor, score) of the pairs at or above the anchor's threshold."""
        x = x[:, self.order].astype(np.float64)
        rest = _rest_norms(x)
        scores = np.zeros((len(x), len(self.q)))
        band, bands = 0, len(self.lists)
        row, anchor = (part.ravel() for part in np.indices(scores.shape)) if not bands else (None, None)
        while band < bands and row is None:
            n = self.lists[band]
            cut = slice(band * BAND, (band + 1) * BAND)
            scores[:, :n] += x[:, cut] @ self.q[:n, cut].T
            band += 1
            # Anchors whose list ended earlier are judged by what they had left out.
            at = np.minimum(self.depth, band)
            able = scores + rest[:, at] * self.rest[np.arange(len(self.q)), at] >= self.thresholds - 1e-6
            if band == bands or not self.lists[band] or np.count_nonzero(able) * BAND < able.size:
                row, anchor = np.nonzero(able)
        score, at = scores[row, anchor], np.minimum(self.depth[anchor], band)
        for b in range(int(at.min(initial=bands)), bands):
            cut = slice(b * BAND, (b + 1) * BAND)
            for part in range(0, len(row), PAIRS // BAND):
                some = slice(part, part + PAIRS // BAND)
                added = np.einsum("ij,ij->i", x[row[some], cut], self.q[anchor[some], cut])
                score[some] += np.where(at[some] <= b, added, 0.0)
            held = score + np.where(at <= b + 1, rest[row, b + 1] * self.rest[anchor, b + 1], np.inf) >= self.thresholds[anchor] - 1e-6
            row, anchor, score, at = row[held], anchor[held], score[held], at[held]
        exact = np.rint(score).astype(np.int64)
        held = exact >= self.thresholds[anchor]
        return row[held], self.rows[anchor[held]], exact[held]


class Best:
    """The first ``size`` rows of each window, by falling score, then rising id."""

    def __init__(self, size: int) -> None:
        self.size, self.held, self.waiting = size, None, []

    def add(self, window: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        self.waiting.append((window, score, vec_id))
        if sum(len(part[0]) for part in self.waiting) > PAIRS // 4:
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = self.waiting + ([self.held] if self.held else [])
        window, score, vec_id = (np.concatenate([p[i] for p in parts] or [np.zeros(0, np.int64)]) for i in range(3))
        order = np.lexsort((vec_id, -score, window))
        window, score, vec_id = window[order], score[order], vec_id[order]
        starts = np.flatnonzero(np.r_[True, window[1:] != window[:-1]]) if len(window) else np.zeros(0, np.int64)
        place = np.arange(len(window)) - np.repeat(starts, np.diff(np.r_[starts, len(window)]))
        kept = place < self.size
        self.held, self.waiting = (window[kept], score[kept], vec_id[kept]), []
        return self.held


@dataclass
class Anchors:
    """The anchors of one block, and the windows below their positives."""

    keys: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray


def _parts(batch: pa.RecordBatch, width: int, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids with a null as the largest number, labels, vectors) of a few rows at a time."""
    for part in slices(batch, rows):
        names = part.schema.names
        ids = part.column(names.index("id")).fill_null(int(LAST))
        yield np.asarray(ids, np.int64), np.asarray(part.column(names.index("label")), np.int64), matrix(part.column(names.index("x")), width)


def _rows_of(best: Best, **more) -> dict:
    window, score, vec_id = best.settle()
    return {"window": window, "score": score, "id": pa.array(vec_id, pa.int64(), mask=vec_id == LAST), **more}


def _partners(rows: DataFrame, block: Anchors, thresholds: np.ndarray, shape: Shape, size: int) -> DataFrame:
    """(window = place of the anchor, score, id): in each task the first rows of the anchor's label, other than itself, at its threshold."""
    width, step = block.vectors.shape[1], PAIRS // max(1, len(block.keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        index, best = Index(block.vectors, thresholds, shape), Best(size)
        for batch in batches:
            for ids, labels, x in _parts(batch, width, step):
                row, anchor, score = index.matches(x)
                kept = (labels[row] == block.labels[anchor]) & (ids[row] != block.ids[anchor])
                best.add(anchor[kept], score[kept], ids[row[kept]])
        yield _rows_of(best)

    return map_arrow(rows, run, "window long, score long, id long")


def _below(rows: DataFrame, block: Anchors, highs: np.ndarray, lows: np.ndarray, shape: Shape, size: int) -> DataFrame:
    """(window = anchor place * windows + place, score, id): rows of other labels within [low, high] of each window; high < low: none wanted."""
    width, step, windows = block.vectors.shape[1], PAIRS // max(1, len(block.keys)), highs.shape[1]
    thresholds = np.where(lows <= highs, lows, np.inf).min(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        index, best = Index(block.vectors, thresholds, shape), Best(size)
        for batch in batches:
            for ids, labels, x in _parts(batch, width, step):
                row, anchor, score = index.matches(x)
                other = labels[row] != block.labels[anchor]
                row, anchor, score = row[other], anchor[other], score[other]
                for place in range(windows):
                    kept = (score <= highs[anchor, place]) & (score >= lows[anchor, place])
                    best.add(anchor[kept] * windows + place, score[kept], ids[row[kept]])
        yield _rows_of(best)

    return map_arrow(rows, run, "window long, score long, id long")


def _first(found: DataFrame, size: int) -> DataFrame:
    order = Window.partitionBy("window").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def _positives(rows: DataFrame, block: Anchors, shape: Shape, size: int) -> tuple[np.ndarray, list[list]]:
    """Scores (anchor x place, negative where there is none) and ids of each anchor's positives."""
    scores, ids = np.full((len(block.keys), size), -1, np.int64), [[] for _ in block.keys]
    norms = np.sqrt((block.vectors.astype(np.float64) ** 2).sum(1))
    todo = np.arange(len(block.keys))
    for share in PARTNER_SHARES:
        some = Anchors(*(part[todo] for part in (block.keys, block.ids, block.labels, block.vectors)))
        thresholds = np.full(len(todo), -np.inf) if share is None else np.ceil(share * norms[todo] * shape.norm)
        found: dict[int, list] = {}
        for row in _first(_partners(rows, some, thresholds, shape, size), size).orderBy("window", "rank").collect():
            found.setdefault(int(todo[row.window]), []).append(row)
        for at, partners in found.items():
            scores[at, :len(partners)], ids[at] = [p.score for p in partners], [p.id for p in partners]
        todo = np.array([at for at in todo if len(found.get(int(at), ())) < size], np.int64)
        if not len(todo):
            break
    return scores, ids


def _negatives(rows: DataFrame, block: Anchors, shape: Shape, scores: np.ndarray, ids: list[list], size: int, percent: int) -> list[str]:
    """Folders with the rows of complete windows, one per round of thresholds. A window below a negative score is empty."""
    spark, windows = rows.sparkSession, scores.shape[1]
    floors, todo, folders = -(-percent * scores // 100), scores >= 0, []
    for step in NEGATIVE_STEPS:
        at = np.flatnonzero(todo.any(1))
        if not len(at):
            break
        highs = np.where(todo[at], scores[at], -np.inf)
        lows = np.where(todo[at], np.ceil(floors[at] + step * (scores[at] - floors[at])), np.inf)
        some = Anchors(*(part[at] for part in (block.keys, block.ids, block.labels, block.vectors)))
        known = spark.createDataFrame(
            [(i * windows + p, int(block.keys[a]), int(block.ids[a]), p, ids[a][p], int(scores[a, p])) for i, a in enumerate(at.tolist())
             for p in np.flatnonzero(todo[a]).tolist()], "window long, anchor long, anchor_id long, place int, positive_id long, positive_score long")
        ranked = _first(_below(rows, some, highs, lows, shape, size), size)
        if step:
            ranked = ranked.withColumn("n", F.count("*").over(Window.partitionBy("window"))).where(F.col("n") == size)
        folders.append(shared_dir(spark, "negatives"))
        ranked.join(F.broadcast(known), "window").select(
            "anchor", "anchor_id", "place", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score")).write.parquet(folders[-1])
        if step:
            places = {int(key): i for i, key in enumerate(block.keys)}
            for row in spark.read.schema(RESULT).parquet(folders[-1]).where("rank = 1").select("anchor", "place").collect():
                todo[places[row.anchor], row.place] = False
    return folders


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, percent: int = 80) -> DataFrame:
    """The hardest rows of other labels below each anchor's positives.

    ``rows`` has ``id`` (long), ``label`` (long) and ``x`` (whole numbers). ``is_anchor`` is a condition on ``id``. An anchor's positives are the
    first rows of its label with another id; a positive's negatives are the first rows of another label whose score is between ``percent`` of the
    positive's score and that score. Higher scores come first, ties by smaller id, a null id last.

    Rows with a null label or vector take no part. Missing components of shorter vectors count as 0. A row without an id is a partner but no
    anchor. Rows that repeat an id are rows of their own, but no partners of an anchor of that id; a repeated anchor is one anchor per row
    (``anchor`` tells them apart). Other columns are ignored. An empty table gives no rows. Components so large that a score could leave the whole
    numbers that doubles hold (2^53) raise a ValueError.
    """
    spark = rows.sparkSession
    kept = written(rows.where("label is not null and x is not null").select("id", "label", "x"), "negatives-rows")
    shape = Shape.of(kept)
    anchors = numbered(kept.where(is_anchor & F.col("id").isNotNull()), ["id"], "negatives-anchors", "anchor")
    total, size = anchors.count(), max(1, BLOCK // max(1, len(shape.order)))
    folders = []
    for start in range(0, total, size):
        got = anchors.where(F.col("anchor").between(start, start + size - 1)).orderBy("anchor").toArrow().combine_chunks()
        part = got.to_batches()[0]
        ids, labels, vectors = next(_parts(part, len(shape.order), part.num_rows))
        block = Anchors(np.asarray(part.column(part.schema.names.index("anchor")), np.int64), ids, labels, vectors)
        scores, partners = _positives(kept, block, shape, positives)
        folders += _negatives(kept, block, shape, scores, partners, negatives, percent)
    return spark.read.schema(RESULT).parquet(*folders) if folders else spark.createDataFrame([], RESULT)
