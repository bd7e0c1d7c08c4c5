"""Near-duplicates by SuperMinHash, banding, verification on full shingle sets, and union-find.

Every shingle owns a random order of the signature's places, and its value at its j-th place lies in [j, j + 1). A place keeps the least value.
Shingles of a text are treated together, one rank j at a time, and the work stops at the first rank that can change nothing any more.
128 values in 32 bands of four find a pair of similarity 0.8 but for a chance of 5 in 10^8.

Texts with the same shingle set are one class from the start. A shingle that only one candidate (later: one component) has is private; the others
are its core, and texts of different components share no more than the smaller core has. Within a band's bucket no pairs are listed: members are compared to one pivot, the
member with the largest share of core, to which the members of a group of copies are closest; then again to a pivot outside the components found
so far. Members of a bucket that are still in different components after these rounds are compared with each other, but only where sizes and cores
leave a link possible, and never two of one component, as such a link adds nothing to the groups. So no link between groups is lost.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from overspend.llm.common import GOLDEN, RollingHash, map_batches, mix, release, written
from overspend.llm.unionfind import components

PLACES, BAND = 128, 4
ROUNDS = 2
#: Parts of the shingles' range in which the cores of the last members are compared.
PARTS = 64
SEGMENT = 1 << 20
#: Rows of ids that are broadcast at most.
BROADCAST_ROWS = 1 << 19
#: Characters of the texts that are worked on together.
TOGETHER = 1 << 16
ROLLING = RollingHash()


def _segments(raw: bytes):
    """Parts of a text of about a megabyte, cut at blanks."""
    start = 0
    while len(raw) - start > SEGMENT:
        end = start + SEGMENT
        while end < len(raw) and raw[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield raw[start:end]
        start = end
    yield raw[start:]


def _hashed(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and where it starts."""
    data = np.frombuffer(raw, np.uint8)
    blank = np.ones(len(data) + 2, bool)
    blank[1:-1] = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    return ROLLING.between(ROLLING.prefix(data), starts, ends) + (ends - starts).astype(np.uint64), starts


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word, A-Z in lower case."""
    return np.concatenate([_hashed(raw)[0] for raw in _segments(text.encode("utf-8", "surrogatepass").lower())])


def _rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    rolled = np.full(len(hashes) - size + 1, size, np.uint64)
    for k in range(size):
        rolled = mix(rolled * GOLDEN + hashes[k:len(hashes) - size + 1 + k])
    return rolled


def _groups(texts: list[str | None]):
    """Positions of the texts that are worked on together: a longer text is alone."""
    found, chars = [], 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if found and chars + size > TOGETHER:
            yield found
            found, chars = [], 0
        found.append(i)
        chars += size
    if found:
        yield found


def shingle_sets(texts: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingles of each text, one text after the other, and how many each has: runs of ``words`` words; a shorter text is one
    shingle, an empty one none."""
    # Each text but the last ends in a blank, so no word crosses texts; a blank ends a word as the end of the text does.
    raws = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
    if len(raws) == 1:
        hashes = word_hashes(texts[0]) if texts[0] else np.empty(0, np.uint64)
        first = np.array([0, len(hashes)])
    else:
        hashes, starts = _hashed(b" ".join(raws).lower())
        first = np.append(np.searchsorted(starts, np.cumsum([0, *(len(raw) + 1 for raw in raws[:-1])])), len(hashes))
    runs = _rolled(hashes, words) if len(hashes) >= words else np.empty(0, np.uint64)
    parts = []
    for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
        if high - low >= words:
            part = runs[low:high - words + 1]
            part.sort()
        else:
            part = _rolled(hashes[low:high], high - low) if high > low else hashes[:0]
        parts.append(part)
    sizes = np.array([len(part) for part in parts])
    items, ends = np.concatenate(parts), np.cumsum(sizes)
    new = np.ones(len(items), bool)
    new[1:] = items[1:] != items[:-1]
    new[(ends - sizes)[sizes > 0]] = True
    before = np.concatenate([[0], np.cumsum(new)])
    return items[new], before[ends] - before[ends - sizes]


def shingles(text: str | None, words: int) -> np.ndarray:
    """The sorted distinct 64-bit shingles of one text."""
    return shingle_sets([text], words)[0]


def superminhashes(items: np.ndarray, owner: np.ndarray, n: int, places: int = PLACES) -> np.ndarray:
    """The signatures of ``n`` sets of 64-bit items, one row each: whole numbers whose upper half is the rank. ``owner`` is the set of each item."""
    best = np.full((n, places), (1 << 64) - 1, np.uint64)
    half, low = np.uint64(32), np.uint64((1 << 32) - 1)
    for start in range(0, len(items), 1 << 14):
        chunk, own, order, first = items[start:start + (1 << 14)], owner[start:start + (1 << 14)], None, None
        for j in range(places):
            going = (best.max(axis=1) >= np.uint64(j << 32))[own]
            if not going.all():
                chunk, own = chunk[going], own[going]
                if order is not None:
                    order = order[going]
                elif first is not None:
                    first = first[going]
            if not len(chunk):
                break
            drawn = mix(chunk + np.uint64((j + 1) * int(GOLDEN) % (1 << 64)))
            at = (j + (((drawn & low) * np.uint64(places - j)) >> half)).astype(np.intp)
            if j == 0:
                place = first = at
            else:
                rows = np.arange(len(chunk))
                if order is None:
                    order = np.tile(np.arange(places, dtype=np.uint8 if places <= 256 else np.int32), (len(chunk), 1))
                    order[rows, first] = 0
                place = order[rows, at].astype(np.intp)
                order[rows, at] = order[:, j]
            np.minimum.at(best.reshape(-1), own * places + place, np.uint64(j << 32) | (drawn >> half))
    return best


def superminhash(items: np.ndarray, places: int = PLACES) -> np.ndarray:
    """The signature of one set of 64-bit items."""
    return superminhashes(items, np.zeros(len(items), np.intp), 1, places)[0]


def band_keys(signature: np.ndarray, band: int = BAND) -> np.ndarray:
    """One 64-bit key per band, of one signature or of each row of them; the band's number is part of it."""
    cells = signature.reshape(*signature.shape[:-1], -1, band)
    keys = np.arange(1, cells.shape[-2] + 1, dtype=np.uint64) * GOLDEN
    for k in range(band):
        keys = mix(keys + cells[..., k])
    return keys.view(np.int64)


def signatures(df: DataFrame, words: int, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(id, n_shingles, set_hash, bands) per row; without shingles both are null."""
    def run(batches):
        for batch in batches:
            out = {"id": batch["id"], "n_shingles": [], "set_hash": [], "bands": []}
            for found in _groups(batch["text"]):
                items, sizes = shingle_sets([batch["text"][i] for i in found], words)
                keys = band_keys(superminhashes(items, np.repeat(np.arange(len(sizes)), sizes), len(sizes)))
                out["n_shingles"] += sizes.tolist()
                out["set_hash"] += [xxhash.xxh3_128_digest(part.tobytes()) if len(part) else None for part in np.split(items, np.cumsum(sizes)[:-1])]
                out["bands"] += [row if size else None for row, size in zip(keys, sizes.tolist())]
            yield out

    rows = df.select(F.col(key).alias("id"), F.col(column).alias("text"))
    return map_batches(rows, run, "id long, n_shingles long, set_hash binary, bands array<long>")


def _sets(df: DataFrame, ids: DataFrame, words: int, key: str, column: str) -> DataFrame:
    """Full shingle sets of the texts to be compared. Rows that repeat id and text are dropped where the join by id has brought them together, before sets exist."""
    def run(batches):
        for batch in batches:
            items = []
            for found in _groups(batch["text"]):
                joined, sizes = shingle_sets([batch["text"][i] for i in found], words)
                items += np.split(joined.view(np.int64), np.cumsum(sizes)[:-1])
            yield {"id": batch["id"], "items": items}

    rows = df.select(F.col(key).alias("id"), F.col(column).alias("text")).join(_bounded(ids), "id", "left_semi").distinct()
    return map_batches(rows, run, "id long, items array<long>")


def _bounded(ids: DataFrame) -> DataFrame:
    """A written table, to be broadcast if it is counted to be small: a few ids then pick rows of a large table that stays where it is."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) with 100 * intersection >= percent * union, and the written table of their ids. The set of ``b`` is moved with the pair; that of ``a``, which may be in very many
    pairs, is joined last and goes no further."""
    small = F.least(F.size("items_a"), F.size("items_b"))
    shared = F.size(F.array_intersect("items_a", "items_b"))
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    sets = sets.join(_bounded(ids), "id", "left_semi")
    joined = pairs.join(sets.select(F.col("id").alias("b"), F.col("items").alias("items_b")), "b").join(
        sets.select(F.col("id").alias("a"), F.col("items").alias("items_a")), "a")
    possible = joined.where(100 * small >= percent * F.greatest(F.size("items_a"), F.size("items_b")))
    sizes = F.size("items_a") + F.size("items_b")
    return possible.where((100 + percent) * shared >= percent * sizes).select("a", "b"), ids


def near_duplicates(df: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) per row: the smallest key that links reach, and whether that is the row's own.

    A text of fewer words than a shingle is one shingle; a null or empty text has none and is linked with nothing. Rows that repeat a key are rows of one
    document, each returned. Rows without a key are returned with a null component and are kept.
    """
    base = written(signatures(df, words, key, column), "signatures")
    classes = (base.where("set_hash is not null and id is not null").groupBy("set_hash")
               .agg(F.min(F.struct("id", "bands")).alias("least")).select("set_hash", F.col("least.id").alias("rep"), F.col("least.bands").alias("bands")))
    classes = written(classes, "classes")
    exploded = classes.select("rep", F.explode("bands").alias("bucket"))
    counts = exploded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    buckets = written(counts, "buckets")
    found = written(exploded.join(buckets, "bucket", "left_semi"), "members")
    release(buckets)
    ids = written(found.select(F.col("rep").alias("id")).distinct(), "ids")
    sets = written(_sets(df, ids, words, key, column), "sets")
    release(ids)
    cores = written(_cores(sets), "cores")
    members = written(found.join(cores, "rep"), "members")
    release(found, cores)

    links, tried, roots, opened = [], [], None, [members]
    for _ in range(ROUNDS):
        now = members.withColumn("root", F.col("rep"))
        if roots is not None:
            now = _open(opened[-1], roots, sets, percent)
            opened.append(now)
            if not now.limit(1).count():
                break
        best = F.max(F.struct((F.col("core") / F.col("size")).alias("share"), (-F.col("rep")).alias("turned"), "root", "core", "size")).alias("top")
        pivots = now.groupBy("bucket").agg(best)
        if roots is not None:
            others = now.join(pivots, "bucket").where(F.col("root") != F.col("top.root")).drop("top")
            pivots = pivots.unionByName(others.groupBy("bucket").agg(best))
        pivots = written(pivots, "pivots")
        near = now.join(pivots, "bucket").where(
            (F.col("root") != F.col("top.root")) & _possible(F.col("size"), F.col("core"), F.col("top.size"), F.col("top.core"), percent))
        pairs = near.select((-F.col("top.turned")).alias("a"), F.col("rep").alias("b")).distinct()
        before = [pivots] if roots is None else [pivots, roots]
        links, tried, roots = _compared(pairs, links, tried, sets, percent)
        release(*before)
    else:
        opened.append(_open(opened[-1], roots, sets, percent))
        if opened[-1].limit(1).count():
            pairs, known = _rest(opened[-1], sets, percent)
            links, tried, roots = _compared(pairs, links, tried, sets, percent)
            release(known)
    release(sets, *opened, *tried)

    same_key = base.where("set_hash is not null and id is not null").join(classes.select("set_hash", "rep"), "set_hash").select("id", "rep")
    joined = written(components(_union(links).unionByName(same_key.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")).distinct())), "roots")
    release(classes, *links)
    return (base.select("id", "n_shingles").join(joined, "id", "left")
            .select(F.col("id").alias(key), "n_shingles", F.coalesce("root", "id").alias("component_id"))
            .withColumn("kept", F.col(key).isNull() | (F.col(key) == F.col("component_id"))))


def _compared(pairs: DataFrame, links: list[DataFrame], tried: list[DataFrame], sets: DataFrame, percent: int):
    """Verify the pairs that were not verified before, and join the components anew."""
    for before in tried:
        turned = before.select(F.col("a").alias("b"), F.col("b").alias("a"))
        pairs = pairs.join(before, ["a", "b"], "left_anti").join(turned, ["a", "b"], "left_anti")
    pairs = written(pairs, "pairs")
    linked, ids = _verified(pairs, sets, percent)
    links = [*links, written(linked, "links")]
    release(ids)
    return links, [*tried, pairs], written(components(_union(links)), "roots")


def _cores(sets: DataFrame) -> DataFrame:
    """(rep, size, core): the size of each set, and how many of its shingles another set has too."""
    items = sets.select("id", F.explode("items").alias("item"))
    private = (items.groupBy("item").agg(F.count("*").alias("n"), F.min("id").alias("rep")).where("n = 1").groupBy("rep").agg(F.count("*").alias("private")))
    # Sets that share an id are bounded together: the smallest size and the largest core.
    sizes = sets.groupBy(F.col("id").alias("rep")).agg(F.min(F.size("items")).cast("long").alias("size"), F.max(F.size("items")).cast("long").alias("core"))
    return sizes.join(private, "rep", "left").select("rep", "size", F.greatest(F.lit(1), F.col("core") - F.coalesce("private", F.lit(0))).alias("core"))


def _outer(sets: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sets of some members, with their component; (rep, item) of the shingles that occur in another component's sets too, once for each set; and the
    written table of the members' ids."""
    reps = written(members.select(F.col("rep").alias("id"), "root").distinct(), "reps")
    held = sets.join(_bounded(reps), "id")
    items = held.select("id", "root", F.explode("items").alias("item"))
    outer = items.groupBy("item").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("item")
    return held, items.join(outer, "item", "left_semi").select(F.col("id").alias("rep"), "item"), reps


def _outer_cores(held: DataFrame, outer: DataFrame) -> DataFrame:
    """(rep, size, core) where the core is what occurs outside of the set's component too."""
    sizes = held.groupBy(F.col("id").alias("rep")).agg(F.min(F.size("items")).cast("long").alias("size"))
    return sizes.join(outer.groupBy("rep").agg(F.count("*").alias("core")), "rep").select("rep", "size", "core")


def _parts(outer: DataFrame) -> DataFrame:
    """(rep, parts): the core counted by parts of the shingles' range. Two sets share at most the sum, over the parts, of the smaller counts."""
    counts = outer.groupBy("rep", F.pmod("item", F.lit(PARTS)).cast("int").alias("part")).agg(F.count("*").cast("int").alias("n"))
    listed = counts.groupBy("rep").agg(F.map_from_entries(F.collect_list(F.struct("part", "n"))).alias("by"))
    return listed.select("rep", F.array(*[F.coalesce(F.col("by")[k], F.lit(0)) for k in range(PARTS)]).alias("parts"))


def _possible(size_a, core_a, size_b, core_b, percent: int):
    """Whether sets of these sizes and cores can be similar enough."""
    most = F.least(core_a, core_b, size_a, size_b)
    return (100 + percent) * most >= percent * (size_a + size_b)


def _open(members: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Members, with their component, that may be linked to a member of another component in their bucket.

    A bucket is summed up by classes of size, each 2 % wide, with its largest core and the largest one outside of that one's component; a member stays if some
    class could hold a partner. Components only grow and cores only shrink, and both ends of a possible link stay, so ``members`` may be what an earlier call
    left open.
    """
    known = members.select("bucket", "rep").join(roots.withColumnRenamed("id", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    rooted = known = written(known, "rooted")
    mixed = known.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("bucket")
    mixed = known = written(known.join(mixed, "bucket", "left_semi"), "mixed")
    release(rooted)
    held, outer, reps = _outer(sets, known)
    cores = written(_outer_cores(held, outer), "cores")
    known = written(known.join(cores, "rep").withColumn("class", F.floor(F.log("size") * 50)), "mixed")
    release(mixed, reps, cores)
    place = ["bucket", "class"]
    classes = known.groupBy(*place).agg(F.min("size").alias("least"), F.max("core").alias("most"), F.max_by("root", "core").alias("of"))
    others = known.join(classes, place).where(F.col("root") != F.col("of")).groupBy(*place).agg(F.max("core").alias("next"))
    classes = written(classes.join(others, place, "left").select(F.col("bucket").alias("same"), "least", "most", "of", "next"), "classes")
    # Without a next one, the class is of one component.
    shared = F.least("core", F.when(F.col("of") != F.col("root"), F.col("most")).otherwise(F.coalesce("next", F.lit(0))))
    fits = (F.col("bucket") == F.col("same")) & ((100 + percent) * shared >= percent * (F.col("size") + F.col("least")))
    still_open = written(known.join(classes, fits, "left_semi").drop("class"), "open")
    release(known, classes)
    return still_open


def _rest(members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of a bucket that belong to different components and may be linked, and the written table they are read from.

    The bound by parts is applied inside the join, so that few pairs leave it. One side leaves out the largest component of each bucket, whose members need not be compared with
    each other.
    """
    _, outer, reps = _outer(sets, members)
    parts = written(_parts(outer), "parts")
    known = written(members.join(parts, "rep"), "rest")
    release(reps, parts)
    counts = known.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    main = counts.groupBy("bucket").agg(F.max_by("root", "n").alias("main"))
    fields = ("rep", "root", "size", "core", "parts")
    left = known.join(main, "bucket").where(F.col("root") != F.col("main")).select("bucket", "main", *[F.col(c).alias(f"{c}_a") for c in fields])
    right = known.select(F.col("bucket").alias("same"), *[F.col(c).alias(f"{c}_b") for c in fields])
    shared = F.aggregate(F.zip_with("parts_a", "parts_b", lambda a, b: F.least(a, b)), F.lit(0), lambda total, least: total + least)
    fits = ((F.col("bucket") == F.col("same")) & ((F.col("root_a") < F.col("root_b")) | ((F.col("root_a") > F.col("root_b")) & (F.col("root_b") == F.col("main"))))
            & _possible(F.col("size_a"), F.col("core_a"), F.col("size_b"), F.col("core_b"), percent)
            & ((100 + percent) * shared >= percent * (F.col("size_a") + F.col("size_b"))))
    pairs = left.join(right, fits).select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct()
    return pairs, known


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
