"""Near-duplicates, repeats and decontamination against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from helpers_llm import edge_rows, empty, frame, groups, lower, shingle_set, words
from overspend.llm import decontaminate, neardup, repeats, unionfind

WORDS = ["alpha", "Beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu"] + [f"w{i}" for i in range(300)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def near_copies(rng):
    rows, base = [], prose(rng, 200)
    for i in range(60):
        parts = base.split()
        for _ in range(rng.randrange(0, 14)):
            parts[rng.randrange(len(parts))] = rng.choice(WORDS)
        rows.append((100 + i, " ".join(parts)))
    return rows + [(i, prose(rng, rng.choice([1, 2, 3, 4, 5, 30, 120]))) for i in range(40)]


# ---- near-duplicates -----------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates_equal_brute_force(spark, size):
    rows = near_copies(random.Random(size))
    found = neardup.near_duplicates(frame(spark, [(i, t, "en", "s") for i, t in rows]), words=size).collect()
    expected = groups(rows, size, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found) and len(found) == len(rows)
    assert len({c for _, c in expected.values()}) > 40  # the copies form several groups


def test_near_duplicates_of_tables(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(documents, words=4).collect()}
    assert found == groups(rows, 4, 80)


def test_a_chain_is_one_group(spark):
    """Each text is near the next one only, so no single pivot reaches all."""
    rng = random.Random(3)
    text = prose(rng, 120).split()
    rows = []
    for i in range(24):
        rows.append((i, " ".join(text)))
        for k in range(2):
            text[(i * 5 + k * 60) % 120] = f"new{i}_{k}"
    expected = groups(rows, 5, 80)
    found = neardup.near_duplicates(frame(spark, [(i, t, "en", "s") for i, t in rows]))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == expected


def test_near_duplicate_edges(spark):
    found = neardup.near_duplicates(frame(spark, edge_rows()), words=4)
    rows = {(r.doc_id): (r.n_shingles, r.component_id, r.kept) for r in found.collect()}
    assert found.count() == len(edge_rows())
    assert rows[1] == (0, 1, True) and rows[2] == (0, 2, True) and rows[3] == (0, 3, True)
    assert rows[4] == (1, 4, True) and rows[5] == (1, 4, False)
    assert rows[8][1:] == (7, False) and rows[9][1:] == (7, False) and rows[10] == (1, 10, True)
    assert rows[None][1:] == (None, True)
    assert neardup.near_duplicates(empty(spark)).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        items = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
        a, b = neardup.superminhash(items[:240]), neardup.superminhash(items[60:])
        errors.append((a == b).mean() - 180 / 300)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < np.sqrt(0.24 / neardup.PLACES)
    one = neardup.superminhash(items[:1])
    assert sorted(one >> np.uint64(32)) == list(range(neardup.PLACES))  # a single item fills every place once
    parts = np.minimum(neardup.superminhash(items[:100]), neardup.superminhash(items[100:]))
    assert (parts == neardup.superminhash(items)).all()


def test_texts_together_have_the_signatures_they_have_alone():
    rng = random.Random(11)
    texts = [None, "", " \n", "a", "A b", "a b c d", "É b\x0bc\x0cd e", prose(rng, 3000), *(prose(rng, n) for n in range(0, 60, 3)), "x " * 200, "tail "]
    together, sizes = neardup.shingle_sets(texts, 4)
    signed = neardup.superminhashes(together, np.repeat(np.arange(len(texts)), sizes), len(texts))
    keys = neardup.band_keys(signed)
    for text, part, signature, key in zip(texts, np.split(together, np.cumsum(sizes)[:-1]), signed, keys):
        alone = neardup.shingles(text, 4)
        assert len(alone) == len(shingle_set(text or "", 4)) and np.array_equal(part, alone)
        assert np.array_equal(signature, neardup.superminhash(alone)) and np.array_equal(key, neardup.band_keys(signature))
    assert sorted(i for part in neardup._groups([*texts, "y " * neardup.TOGETHER, "z"]) for i in part) == list(range(len(texts) + 2))


def _last_members(spark, sets, members, roots):
    """Arguments of the last rounds, from items by id, (bucket, id) and (id, root)."""
    held = spark.createDataFrame([(i, sorted(items)) for i, items in sets.items()], "id long, items array<long>")
    return spark.createDataFrame(members, "bucket long, rep long"), spark.createDataFrame(roots, "id long, root long"), held


def test_a_group_does_not_stay_open_for_its_own_members(spark):
    """Ten sets of one component are much like a set elsewhere, but the only other member of their bucket shares a fifth with them."""
    sets = {i: {*range(100), 1000 + i} for i in range(1, 11)}
    sets |= {50: {*range(20), *range(2000, 2080)}, 60: {*range(100)}, 61: {*range(3000, 3100)}}
    members, roots, held = _last_members(spark, sets, [*((1, i) for i in [*range(1, 11), 50]), (2, 60), (2, 61)], [(i, 1) for i in range(1, 11)])
    assert neardup._open(members, roots, held, 80).count() == 0
    sets[50] = {*range(95), *range(2000, 2005)}
    members, roots, held = _last_members(spark, sets, [*((1, i) for i in [*range(1, 11), 50]), (2, 60), (2, 61)], [(i, 1) for i in range(1, 11)])
    assert {r.rep for r in neardup._open(members, roots, held, 80).collect()} == {*range(1, 11), 50}


def test_rest_gives_each_pair_of_components_that_may_be_linked(spark):
    rng = random.Random(5)
    sets = {i: {*rng.sample(range(110), 98)} for i in range(40)}
    roots = {i: i if i > 25 else i % 3 * (i % 2) for i in range(40)}
    roots = {i: min(j for j in roots if roots[j] == r) for i, r in roots.items()}
    members, given, held = _last_members(spark, sets, [(b, i) for b in range(3) for i in range(40)], list(roots.items()))
    still = neardup._open(members, given, held, 80)
    pairs, _ = neardup._rest(still, held, 80)
    found = [(r.a, r.b) for r in pairs.collect()]
    assert len(found) == len(set(found)) and all(a < b and roots[a] != roots[b] for a, b in found)
    alike = {(a, b) for a in sets for b in sets if a < b and roots[a] != roots[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert alike and alike <= set(found)


def test_shingles_are_words_of_ascii_lower_case():
    assert len(neardup.shingles("A b\tC  d\ne", 4)) == 2 and (neardup.shingles("A b C d e", 4) == neardup.shingles("a B c D E", 4)).all()
    assert not np.array_equal(neardup.shingles("É b c d", 4), neardup.shingles("é b c d", 4))
    text = " ".join(f"w{i % 977}" for i in range(400_000))
    assert len(neardup.shingles(text, 4)) == len(shingle_set(text, 4))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, edges):
    found = {r.id: r.root for r in unionfind.components(spark.createDataFrame(edges or [(1, 1)], "a long, b long").repartition(4)).collect()}
    forest = unionfind.Forest()
    for a, b in edges:
        forest.join(a, b)
    assert found == {n: forest.find(n) for e in edges if e[0] != e[1] for n in e}


# ---- repeats -------------------------------------------------------------------------------------------------------------

def brute_repeats(rows):
    places = {}
    for row, raw in enumerate(rows):
        for i in range(len(raw) - 399):
            places.setdefault(raw[i:i + 400], []).append((row, i))
    covered = [bytearray(len(raw)) for raw in rows]
    for found in places.values():
        if len(found) > 1:
            for row, i in found:
                covered[row][i:i + 400] = b"\1" * 400
    out = []
    for raw, mask in zip(rows, covered):
        kept = bytes(b for b, m in zip(raw, mask) if not m)
        out.append((len(raw), sum(mask), sum(1 for i, m in enumerate(mask) if m and (not i or not mask[i - 1])), hashlib.sha256(kept).hexdigest()))
    return out


def repeat_texts(rng):
    base, passage = prose(rng, 400), prose(rng, 90)
    texts = [base, base, base[100:1500], base[:410] + "#" + base[410:], "é" + base[37:900] + "日本", prose(rng, 50) + passage + prose(rng, 50), passage + "x", "y" + passage,
             "ab" * 350, "ab" * 230 + "c", "z" * 401, "z" * 399, "", None, base[:399], base[:400], passage[3:], "q" * 1000, passage + passage]
    for _ in range(25):
        parts = list(base)
        for _ in range(rng.randrange(1, 5)):
            parts[rng.randrange(len(parts))] = rng.choice("#é%")
        texts.append("".join(parts)[rng.randrange(50):])
    for n in range(398, 404):
        texts.append(prose(rng, 8) + passage[20:20 + n] + prose(rng, 9))
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_equal_brute_force(spark, seed):
    texts = repeat_texts(random.Random(seed))
    found = repeats.digest(repeats.remove_repeats(frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]).repartition(5))).collect()
    expected = brute_repeats([(t or "").encode() for t in texts])
    assert {r.doc_id: tuple(r)[1:5] for r in found} == dict(enumerate(expected))


def test_repeats_of_tables(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = documents.collect()
    found = repeats.digest(repeats.remove_repeats(documents)).collect()
    assert {r.doc_id: tuple(r)[1:5] for r in found} == dict(zip([r.doc_id for r in rows], brute_repeats([r.text.encode() for r in rows])))


def test_repeat_edges(spark):
    rows = edge_rows()
    found = repeats.digest(repeats.remove_repeats(frame(spark, rows)))
    by_id = {r.doc_id: r for r in found.collect()}
    assert found.count() == len(rows)
    assert by_id[7].n_removed == by_id[7].n_bytes and by_id[8].n_spans == 1 and by_id[11].n_removed == 70_000
    assert by_id[9].n_bytes - by_id[9].n_removed == 4 and by_id[1].n_bytes == 0 and by_id[10].n_removed == 0
    same_id = frame(spark, [(1, "a" * 900, "en", "s"), (1, prose(random.Random(1), 200), "en", "s"), (None, "a" * 900, "en", "s")])
    assert sorted(r.n_removed for r in repeats.digest(repeats.remove_repeats(same_id)).collect()) == [0, 900, 900]
    assert repeats.digest(repeats.remove_repeats(empty(spark))).count() == 0


def brute_sharers(texts):
    holders = {}
    for row, text in enumerate(texts):
        found = words(lower(text))
        for i in range(len(found) - 50):
            holders.setdefault(tuple(found[i:i + 51]), set()).add(row)
    return {row for rows in holders.values() if len(rows) > 1 for row in rows}


def test_passage_sharers_equal_brute_force(spark):
    rng = random.Random(6)
    short = " ".join(rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(70))
    parts = short.split()
    texts = repeat_texts(random.Random(1)) + [" ".join(f"{c}{k}" for k in range(60)) for c in "mn"] + [
        prose(rng, 30) + " " + " ".join(parts[a:a + n]).upper() + "\n" + prose(rng, 30) for a, n in ((0, 51), (5, 51), (9, 55), (0, 50), (10, 50), (19, 51))]
    texts += ["own " * 200, prose(rng, 60) + " " + " ".join(parts[2:50])]
    found = repeats.remove_repeats(frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]).repartition(3)).collect()
    assert {r.doc_id for r in found if r.shares_passage} == brute_sharers(texts)
    twice = repeats.remove_repeats(frame(spark, [(1, short, "en", "s"), (1, short, "en", "s"), (2, "own " * 200, "en", "s"), (None, None, "en", "s")])).collect()
    assert sorted((r.doc_id or 0, r.shares_passage) for r in twice) == [(0, False), (1, True), (1, True), (2, False)]


def test_word_marks_cover_every_window(monkeypatch):
    monkeypatch.setattr(repeats, "WORD_SEGMENT", 80)
    hashes = neardup.word_hashes(prose(random.Random(9), 700))
    seen = []
    for _, place, low, high in repeats.word_marks(hashes):
        assert low <= high <= place <= low + 50 - 16
        seen += range(low, high + 1)
    assert seen == list(range(650)) and list(repeats.word_marks(hashes[:50])) == []


def test_marks_cover_every_window(monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 2000)
    data = np.frombuffer(prose(random.Random(4), 1500).encode(), np.uint8)
    seen = []
    for place, low, high in repeats.marks(data):
        assert low <= place <= low + repeats.SPAN - 1 and high <= place
        seen += range(low, high + 1)
    assert seen == list(range(len(data) - 399))


# ---- decontamination -----------------------------------------------------------------------------------------------------

def edit_distance_within(piece, text):
    """Fewest edits between the piece and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(piece, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_leaks_equal_brute_force(spark):
    rng = random.Random(8)
    items = [(i, prose(rng, n)) for i, n in enumerate([3, 8, 20, 45, 60, 25])] + [(6, "short"), (7, None), (8, "Été à la plage, où l'épée s'élève")]
    rows = []
    for i in range(60):
        text = prose(rng, 40)
        piece = list(rng.choice([t for _, t in items if t]))
        for _ in range(rng.randrange(0, 1 + len(piece) // 7)):
            at = rng.randrange(len(piece))
            piece[at:at + rng.choice([0, 1, 1])] = rng.choice(["", "x", "é", " "])
        rows.append((i, (text + "  " + "".join(piece).upper() + "\n" + prose(rng, 5)) if i % 2 else text))
    found = decontaminate.leaks(frame(spark, [(i, t, "en", "s") for i, t in rows]), spark.createDataFrame(items, "item_id long, text string")).collect()
    expected = {}
    for i, text in rows:
        for item, question in items:
            for piece in decontaminate.pieces(question):
                if (edits := edit_distance_within(piece, decontaminate.normal(text))) <= decontaminate.budget(len(piece)):
                    n, best = expected.get((i, item), (0, 1 << 30))
                    expected[i, item] = n + 1, min(best, edits)
            if 0 < len(short := decontaminate.normal(question)) < 8 and re.search(rf"(?<!\w){re.escape(short)}(?!\w)", decontaminate.normal(text)):
                expected[i, item] = 1, 0
    assert {(r.doc_id, r.item_id): (r.n_pieces, r.edits) for r in found} == expected
    assert len(expected) > 15 and any(e for _, e in expected.values())


def test_lemma_bound_is_positive():
    for size in range(8, 200):
        assert size + 1 - decontaminate.Q * (decontaminate.budget(size) + 1) >= 1


def test_leak_edges(spark, monkeypatch):
    benchmark = spark.createDataFrame([(1, "a row without an id"), (1, "a row without an id"), (2, None), (None, "one two three four"), (3, "")], "item_id long, text string")
    docs = frame(spark, edge_rows())
    assert [tuple(r) for r in decontaminate.leaks(docs, benchmark).collect()] == [(None, 1, 1, 0, 0)]
    assert decontaminate.without_leaks(docs, benchmark).count() == len(edge_rows()) - 1
    assert decontaminate.without_leaks(docs, benchmark).columns == docs.columns
    assert decontaminate.leaks(docs, benchmark.where("false")).count() == 0 and decontaminate.leaks(empty(spark), benchmark).count() == 0
    # Short items are found as whole words; rows without an id, and rows that share one, are judged each by its own text.
    few = spark.createDataFrame([(1, "is it"), (2, "C++"), (3, "日本")], "item_id long, text string")
    rows = [(1, "see: 42 IS  it?"), (2, "this item"), (3, "a C++ text"), (4, "日本語"), (None, "is it"), (None, "clean"), (5, "is it"), (5, "clean")]
    docs_of = frame(spark, [(i, t, "en", "s") for i, t in rows])
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(docs_of, few).collect() if r.doc_id) == [(1, 1), (3, 2), (5, 1)]
    assert sorted((r.doc_id or 0, r.text) for r in decontaminate.without_leaks(docs_of, few).collect()) == [(0, "clean"), (2, "this item"), (4, "日本語"), (5, "clean")]
    # A passage at the border of two windows, and a benchmark in many blocks.
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 10)
    monkeypatch.setattr(decontaminate, "WINDOW", 2000)
    rng = random.Random(2)
    passage = prose(rng, 50)
    for lead in (1100, 1300, 1350, 1999):
        found = decontaminate.Index([(5, passage)]).matches(["y" * lead + " " + passage + " " + prose(rng, 400)])[0]
        assert found[5][:2] == (len(decontaminate.pieces(passage)), 0)
    assert decontaminate.leaks(docs, benchmark).count() == 1
