"""Hard negatives, Hilbert shards and whitening against brute-force versions."""

import itertools
import random
import zlib

import numpy as np
import pytest
from helpers_llm import edge_rows, empty, frame
from pyspark.sql import functions as F

from overspend.llm import hilbert, negatives, queries, whitening
from overspend.llm.common import table
from overspend.llm.vectors import is_finite, numbered, whole

SF = "/root/testdata/sf0.01"
SCHEMA = "id long, label long, x array<long>, score string, window int, rank string"


def mined(rows, percent=80, positives=5, size=5):
    """(anchor, positive, rank, negative, scores) by scoring everything."""
    out = []
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    rows = [r for r in rows if r[1] is not None and r[2] is not None]
    for a in rows:
        if a[0] is None or a[0] % 100:
            continue
        scored = [(sum(p * q for p, q in zip(a[2], r[2])), r[0], r[1]) for r in rows if r[0] != a[0]]
        for s, i, _ in sorted([r for r in scored if r[2] == a[1]], key=order)[:positives]:
            window = sorted([r for r in scored if r[2] != a[1] and percent * s <= 100 * r[0] <= 100 * s], key=order)[:size]
            out += [(a[0], i, n + 1, r[1], s, r[0]) for n, r in enumerate(window)]
    return sorted(out, key=repr)


def mine(spark, rows, **more):
    df = spark.createDataFrame([(i, lab, x, "s", 1, "r") for i, lab, x in rows], SCHEMA)
    found = negatives.hard_negatives(df, F.col("id") % 100 == 0, **more)
    return sorted(map(tuple, found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=repr)


def test_negatives_equal_brute_force(spark, monkeypatch):
    """Sparse, signed and hot vectors, several blocks of anchors, windows that fill at different thresholds."""
    random.seed(3)
    monkeypatch.setattr(negatives, "BLOCK", 40)
    rows = [(i * 5, random.randrange(4), [random.choice([0, 0, 0, random.randrange(-9, 30)]) for _ in range(20)]) for i in range(400)]
    rows += [(10_000 + i, i % 3, [3] * 20) for i in range(300)]
    got = mine(spark, rows)
    assert got == mined(rows) and len({r[0] for r in got}) > 15


def test_negatives_edge_rows(spark):
    """Nulls, ties, repeated rows and anchors, shorter and empty vectors, a label of its own, a null id."""
    x = [4, 1, 0, 2]
    rows = [(0, 1, x), (100, 1, x), (100, 1, x), (200, 9, x), (300, 2, []), (400, None, x), (500, 1, None), (None, 1, x), (None, 2, x), (7, 2, x), (8, 2, x),
            (8, 2, x), (9, 3, [4]), (11, 1, [4, 1]), (600, 2, [-4, -1]), (12, 3, [0, 0, 0, 0, 0, 9])]
    want = [r for r in mined([r if r[2] is None else (r[0], r[1], r[2] + [0] * (6 - len(r[2]))) for r in rows])]
    assert mine(spark, rows) == want
    assert mine(spark, []) == [] and mine(spark, [(0, 1, x)]) == [] and mine(spark, [(1, 1, x), (2, 2, x)]) == []
    with pytest.raises(Exception, match="too large"):
        mine(spark, [(0, 1, [1 << 40]), (1, 1, [1 << 40])])


def test_index_prunes_and_loses_nothing():
    """The index leaves dimensions out, and its matches are all pairs at the threshold."""
    rng = np.random.default_rng(1)
    x, q = (np.rint(rng.normal(size=(n, 40)) * np.geomspace(60, 1, 40)).astype(np.int64) for n in (500, 50))
    order = np.arange(40)
    shape = negatives.Shape(order, np.abs(x).max(0).astype(float), float(np.sqrt((x * x).sum(1).max())))
    full = x @ q.T
    for share in (0.2, 0.5, 0.9, None):
        t = np.full(50, -np.inf) if share is None else np.ceil(share * np.sqrt((q * q).sum(1)) * shape.norm)
        index = negatives.Index(q, t, shape)
        row, anchor, score = index.matches(x)
        want = {(i, j): int(full[i, j]) for i, j in zip(*np.nonzero(full >= t))}
        assert dict(zip(zip(row.tolist(), anchor.tolist()), score.tolist())) == want
        assert share is None or sum(index.lists) < 5 * 50


def test_negatives_of_the_table(spark):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, [int(np.floor(256 * float(c))) for c in r.embedding])
            for r in table(spark, SF, "embeddings").collect()]
    got = queries.op11_hard_negatives(spark, SF)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect()), key=repr) == mined(rows)


@pytest.mark.parametrize("size,bits", [(1, 5), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_all_cells_in_unit_steps(spark, size, bits):
    cells = list(itertools.product(range(1 << bits), repeat=size))
    df = spark.createDataFrame(cells, ", ".join(f"c{i} int" for i in range(size)))
    placed = df.withColumn("at", hilbert.curve_index([F.col(f"c{i}") for i in range(size)], bits)).orderBy("at").collect()
    assert [r["at"] for r in placed] == list(range(len(cells)))
    assert all(sum(abs(a - b) for a, b in zip(p[:-1], q[:-1])) == 1 for p, q in zip(placed, placed[1:]))


def law_holds(rows, shards=24):
    """Slots gapless, counts at most one apart, the curve never falls from one row to the next."""
    rows = sorted(rows, key=lambda r: (r.shard, r.slot))
    sizes = [sum(r.shard == s for r in rows) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and all(0 <= r.shard < shards for r in rows)
    assert [r.slot for r in rows] == [i for n in sizes for i in range(n)]
    assert all(a.curve <= b.curve for a, b in zip(rows, rows[1:]))


def test_shards_of_the_table(spark):
    docs = table(spark, SF, "documents").collect()
    rows = queries.op12_hilbert_shards(spark, SF).collect()
    law_holds(rows)
    texts = {d.doc_id: (d.text or "").encode() for d in docs}
    assert sorted(r.doc_id for r in rows) == sorted(texts) and all(r.law == "rows" and r.grown_shard is None for r in rows)
    assert all((r.size, r.text_crc32) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id])) for r in rows)


def test_shards_prune_files_in_every_dimension(spark):
    """Runs of the curve need fewer shards for a value of any dimension than runs by id."""
    docs = table(spark, SF, "documents")
    sharded = hilbert.shard_documents(docs)
    plain = numbered(hilbert.with_sizes(docs), ["doc_id"], "plain").withColumn("shard", F.expr("position * 24 div 1000"))

    def touched(rows, condition):
        return hilbert.manifest(rows).where(condition).count()

    large = sharded.approxQuantile("size", [0.95], 0.001)[0]
    top = docs.groupBy("source").count().orderBy("count").first().source
    for condition in (f"min_source <= '{top}' AND max_source >= '{top}'", "min_lang <= 'en' AND max_lang >= 'en'", f"max_size >= {large}"):
        assert touched(sharded, condition) < touched(plain, condition)


def test_shards_by_bytes(spark):
    rows = hilbert.shard_documents(table(spark, SF, "documents"), shards=7, law="bytes").collect()
    total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    for s in range(7):
        own = sorted(r.slot for r in rows if r.shard == s)
        assert own == list(range(len(own)))
        assert abs(sum(r["size"] for r in rows if r.shard == s) - total / 7) <= largest
    with pytest.raises(ValueError, match="no law"):
        hilbert.shard_documents(table(spark, SF, "documents"), law="key")


def test_shards_of_edge_rows(spark, tmp_path):
    """Nulls in any column, repeated rows, clashing columns, more shards than rows, an empty table; files hold all rows in order."""
    docs = frame(spark, edge_rows()).withColumn("slot", F.lit("x")).withColumn("curve", F.lit("y"))
    law_holds(hilbert.shard_documents(docs).collect())
    law_holds(hilbert.shard_documents(docs, shards=3).collect(), 3)
    assert hilbert.shard_documents(empty(spark)).collect() == [] and hilbert.shard_documents(empty(spark), law="bytes").collect() == []
    nothing = frame(spark, [(None, None, None, None)] * 50)
    law_holds(hilbert.shard_documents(nothing).collect())
    hilbert.write_shards(docs, str(tmp_path / "shards"), shards=4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    key = lambda r: repr((r.doc_id, r.text, r.key))
    assert sorted(map(key, back.collect())) == sorted(map(key, docs.collect()))
    assert {r.shard: r.n for r in back.groupBy("shard").agg((F.max("slot") + 1).alias("n")).collect()} == {
        r.shard: r["count"] for r in back.groupBy("shard").count().collect()}


def test_hot_cell_is_spread(spark):
    """Equal rows are numbered by several tasks, none of which writes more than a share of them."""
    import pyarrow.parquet as pq
    same = spark.range(400_000).select(F.lit(1).alias("a"))
    got = numbered(same, ["a"], "same-rows")
    assert got.agg(F.count_distinct("position"), F.min("position"), F.max("position")).first() == (400_000, 0, 399_999)
    sizes = [pq.read_metadata(f.removeprefix("file://")).num_rows for f in set(got.inputFiles())]
    assert sum(sizes) == 400_000 and max(sizes) < 300_000


def test_eigen_equals_lapack():
    rng = np.random.default_rng(5)
    for size, rank in ((1, 1), (2, 2), (9, 9), (12, 5), (64, 64)):
        a = rng.normal(size=(rank, size)) * np.geomspace(100, 0.01, rank)[:, None]
        v = a.T @ a
        values, vectors = whitening.eigen(v)
        want = np.linalg.eigvalsh(v)[::-1][:rank]
        assert len(values) == rank and np.allclose(values, want, rtol=1e-9)
        assert np.abs(v @ vectors - vectors * values).max() < 1e-12 * values[0] * size and np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-9)
    assert whitening.eigen(np.zeros((3, 3)))[0].shape == (0,) and whitening.eigen(np.zeros((0, 0)))[0].shape == (0,)


def whitened(rows, fill, k=16):
    """id, exact deviation, and projections up to sign, by LAPACK."""
    width = max((len(x) for _, x in rows), default=0)
    rows = [(i, tuple(x) + (fill,) * (width - len(x))) for i, x in rows]
    fitted = np.array(sorted({x for _, x in rows}), dtype=object)
    n, sums = len(fitted), fitted.sum(0)
    y = np.array(fitted * n - sums, float) / n
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    order = [j for j in np.argsort(-values) if values[j] > 1e-9 * values.max()][:k]
    out = {}
    for i, x in rows:
        d = [n * c - s for c, s in zip(x, sums)]
        out[i] = (n, sum(c * c for c in d), np.abs(np.array(d, float) / n @ vectors[:, order] / np.sqrt(values[order])))
    return out, values[order] / np.trace(v)


def equal(got, want, shares):
    for i, (n, deviation, numbers) in want.items():
        own = sorted((r for r in got if r[0] == i), key=lambda r: r.component)
        assert [r.component for r in own] == list(range(1, len(numbers) + 1))
        assert all(r.n == n and r.deviation == deviation for r in own)
        assert np.allclose([abs(r.whitened) for r in own], numbers, atol=1e-7)
        assert np.allclose([r.explained for r in own], shares, rtol=1e-9) and all(0 <= r.identity_error < 1e-9 for r in own)


def test_whitening_of_the_table(spark):
    rows = [(r.vec_id, [int(np.floor(64 * float(c))) + 1_000_000 for c in r.embedding]) for r in table(spark, SF, "embeddings").collect()]
    got = queries.op13_whitening(spark, SF).collect()
    assert len(got) == 16 * len(rows)
    equal(got, *whitened(rows, 1_000_000))


def test_whitening_of_edge_rows(spark):
    schema = "id long, x array<long>, component string, n string, deviation string"
    rows = [(1, [5, 9, 2]), (2, [5, 9, 2]), (3, [1, 1]), (4, []), (5, [7, 0, 3]), (5, [7, 0, 3]), (6, [2, 2, 2]), (8, [3, 8, 1])]
    df = spark.createDataFrame([(i, x, "c", "n", "d") for i, x in [*rows, (7, None), (None, [7, 0, 3])]], schema)
    got = whitening.whiten(df, fill=4).collect()
    assert len(got) == 9 * 3 and sum(r.id is None for r in got) == 3 and sum(r.id == 5 for r in got) == 6
    seen = {(r.id, r.component): r for r in got}
    equal(list(seen.values()), *whitened(rows, 4))
    assert whitening.whiten(df.limit(0)).collect() == [] and whitening.whiten(df.where("id in (1, 2)")).collect() == []
    # Equal variance in no direction but one: one component.
    flat = spark.createDataFrame([(i, [i, 2 * i], "c", "n", "d") for i in range(4)], schema)
    assert {r.component for r in whitening.whiten(flat).collect()} == {1}
    wide = spark.createDataFrame([(i, [i << 40, i], "c", "n", "d") for i in range(3)], schema)
    assert {r.deviation for r in whitening.whiten(wide).collect()} == {None, 0}


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1, [0.5, -0.01]), (2, None), (3, [None, 1.0]), (4, [nan]), (5, [inf]), (6, [-inf, 0.0]), (7, [])], "id long, v array<float>")
    kept = df.where(is_finite("v")).select("id", whole("v", 256).alias("a"), whole("v", 64, 1_000_000).alias("b")).collect()
    assert [tuple(r) for r in kept] == [(1, [128, -3], [1_000_032, 999_999]), (7, [], [])]
