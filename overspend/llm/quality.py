"""Quality rules: text statistics, fixed limits, and robust outliers by language and source. DataFrame operations only.

The statistics of a text are one expression over its words and lines. Four transformed statistics make a vector, in
thousandths as whole numbers: log of 1 + symbols per 100 words, log of the mean word length, share of repeated lines, share of words in repeated
windows. For each language and source the minimum covariance determinant is approached from two starts, medians with median absolute
deviations and mean with covariance of all rows, by concentration steps: measure Mahalanobis distances, keep the nearest three quarters, take their mean and
covariance, and again until no group's determinant falls any more. Each group takes the start that ended at the smaller determinant. Rows farther than
``CUTOFF`` from that estimate are rejected.

Every sum is a sum of whole numbers, and every quantile is read from a histogram with a bounded number of bins per group, so a group of any size is
partially aggregated and the result does not depend on how rows are dealt out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from overspend.llm.common import release, written

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
FEATURES = ("symbols", "length", "lines", "windows")
#: Smallest standard deviations, in thousandths: a statistic that is constant in a group must not make every other value an outlier.
FLOORS = {"symbols": 350, "length": 70, "lines": 140, "windows": 70}
KEEP_SHARE, MIN_ROWS = 0.75, 50
#: Steps at most, and the fall of the log determinant that counts as one. Tables of all sizes seen settle well before.
STEPS, FALL = 20, 1e-6
#: Brings the covariance of the nearest three quarters of normal vectors of four numbers up to that of all.
CONSISTENCY = 1.486
#: Squared distance; a normal vector of four numbers exceeds it once in 2 x 10^7. Clean texts of the labelled tables stay below it.
CUTOFF = 40.0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated_words(words: Column) -> Column:
    """Words in three-word windows that occur at least twice."""
    windows = F.transform(F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>")),
                          lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1), p + 3) - p))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def repeats(ranked: Column) -> Column:
        def same(x: Column, k: Column) -> Column:
            before, after = F.get(ranked, k - 1), F.get(ranked, k + 1)
            return F.when(F.coalesce(before["w"] == x["w"], F.lit(False)) | F.coalesce(after["w"] == x["w"], F.lit(False)), x["i"])

        return let(F.array_sort(F.filter(F.transform(ranked, same), lambda i: i.isNotNull())), covered)

    def count(w: Column) -> Column:
        ranked = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(let(ranked, repeats))

    return let(windows, count)


def text_statistics(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words; all 0 for a null or empty text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def of(words: Column) -> Column:
        return let(lines, lambda kept: F.struct(
            F.size(words).cast("long").alias("n_words"), F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            F.size(kept).cast("long").alias("n_lines"), (F.size(kept) - F.size(F.array_distinct(kept))).cast("long").alias("n_dup_lines"),
            _repeated_words(words).cast("long").alias("n_repeat_words")))

    return let(F.array_remove(F.split(text, BLANKS, -1), ""), of)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def features() -> list[Column]:
    """The vector as whole thousandths; null for rows without words."""
    words, thousand = F.nullif(F.col("n_words"), F.lit(0).cast("long")), F.lit(1000.0)
    values = {"symbols": F.log1p(100 * F.col("n_symbols") / words), "length": F.log(F.col("word_chars") / words),
              "lines": F.col("n_dup_lines") / F.nullif(F.col("n_lines"), F.lit(0).cast("long")), "windows": F.col("n_repeat_words") / words}
    return [F.round(values[name] * thousand).cast("long").alias(name) for name in FEATURES]


KEYS = ["lang_key", "source_key"]
RUN = [*KEYS, "start"]


def _quantile(counts: DataFrame, value: str, share: float, name: str, keys: list[str] = KEYS) -> DataFrame:
    """Per group, the least value that ``share`` of the rows do not exceed; ``counts`` has one row for each group and value."""
    running = F.sum("n").over(Window.partitionBy(*keys).orderBy(value))
    total = F.sum("n").over(Window.partitionBy(*keys))
    return (counts.withColumn("running", running).withColumn("total", total).where(F.col("running") >= F.ceil(F.col("total") * share))
            .groupBy(*keys).agg(F.min(value).alias(name)))


def _medians(rows: DataFrame) -> DataFrame:
    """Medians, and variances from median absolute deviations, per group."""
    found = None
    for name in FEATURES:
        counts = rows.groupBy(*KEYS, name).agg(F.count("*").alias("n"))
        middle = _quantile(counts, name, 0.5, f"m_{name}")
        away = counts.join(middle, KEYS).withColumn("away", F.abs(F.col(name) - F.col(f"m_{name}"))).groupBy(*KEYS, "away").agg(F.sum("n").alias("n"))
        both = middle.join(_quantile(away, "away", 0.5, f"s_{name}"), KEYS)
        found = both if found is None else found.join(both, KEYS)
    zero = F.lit(0.0)
    cells = [(F.pow(F.col(f"s_{a}") * 1.4826, 2) if a == b else zero).alias(f"v_{a}_{b}") for a, b in _cells()]
    return found.select(*KEYS, *[F.col(f"m_{n}").cast("double").alias(f"m_{n}") for n in FEATURES], *cells)


def _cells() -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(FEATURES) for b in FEATURES[:i + 1]]


def _factored(estimate: DataFrame, scale: float) -> DataFrame:
    """The Cholesky factor of each estimate's covariance, whose diagonal is raised by the floors, and the log of its determinant. One row per group and start."""
    size = len(FEATURES)
    for i in range(size):
        for j in range(i + 1):
            cell = F.col(f"v_{FEATURES[i]}_{FEATURES[j]}") * scale + (float(FLOORS[FEATURES[i]] ** 2) if i == j else 0.0)
            for k in range(j):
                cell = cell - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            estimate = estimate.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(cell, F.lit(1.0))) if i == j else cell / F.col(f"l_{j}_{j}"))
    log_det = sum((2 * F.log(f"l_{i}_{i}") for i in range(size)), F.lit(0.0))
    return estimate.select(*RUN, log_det.alias("log_det"), *[f"m_{n}" for n in FEATURES], *[f"l_{i}_{j}" for i in range(size) for j in range(i + 1)])


def _measured(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Adds ``start`` and ``distance``, the squared Mahalanobis distance, by forward substitution; one row for each start of ``estimate``, which is small."""
    joined = rows.join(estimate, KEYS, "left")
    for i, name in enumerate(FEATURES):
        rest = F.col(name) - F.col(f"m_{name}")
        for k in range(i):
            rest = rest - F.col(f"l_{i}_{k}") * F.col(f"y_{k}")
        joined = joined.withColumn(f"y_{i}", rest / F.col(f"l_{i}_{i}"))
    distance = sum((F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(len(FEATURES))), F.lit(0.0))
    return joined.withColumn("distance", distance).select(*rows.columns, "start", "distance")


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and covariance per group, from sums of whole numbers."""
    whole = "decimal(38,0)"
    sums = rows.groupBy(*keys).agg(
        F.count("*").alias("n"), *[F.sum(F.col(a).cast("decimal(18,0)")).alias(f"s_{a}") for a in FEATURES],
        *[F.sum((F.col(a) * F.col(b)).cast("decimal(18,0)")).cast(whole).alias(f"p_{a}_{b}") for a, b in _cells()])
    means = {a: F.col(f"s_{a}").cast("double") / F.col("n") for a in FEATURES}
    return sums.select(*keys, *[means[a].alias(f"m_{a}") for a in FEATURES],
                       *[(F.col(f"p_{a}_{b}").cast("double") / F.col("n") - means[a] * means[b]).alias(f"v_{a}_{b}") for a, b in _cells()])


def _concentrate(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """One step: mean and covariance of the nearest rows of each group and start. Distances are compared in steps of a hundredth of their log."""
    near = _measured(rows, estimate).withColumn("bin", F.floor(100 * F.log1p("distance")))
    limit = written(_quantile(near.groupBy(*RUN, "bin").agg(F.count("*").alias("n")), "bin", KEEP_SHARE, "limit", RUN), "quality-limit")
    after = written(_factored(_moments(near.join(limit, RUN).where(F.col("bin") <= F.col("limit")), RUN), CONSISTENCY), "quality-estimate")
    release(limit)
    return after


def least_determinant(rows: DataFrame) -> DataFrame:
    """Per group of ``rows`` (KEYS, FEATURES), the estimate of the smallest determinant that the starts settle at."""
    starts = _medians(rows).withColumn("start", F.lit(0)).unionByName(_moments(rows, KEYS).withColumn("start", F.lit(1)))
    estimate = written(_factored(starts, 1.0), "quality-estimate")
    for step in range(STEPS):
        before, estimate = estimate, _concentrate(rows, estimate)
        # The starts are no estimates of three quarters, so their determinants are not compared.
        fell = step == 0 or estimate.join(before.select(*RUN, F.col("log_det").alias("was")), RUN).where(F.col("log_det") < F.col("was") - FALL).limit(1).count()
        release(before)
        if not fell:
            break
    others = [c for c in estimate.columns if c not in (*RUN, "log_det")]
    least = estimate.groupBy(*KEYS).agg(F.min(F.struct("log_det", "start", *others)).alias("least")).select(*KEYS, "least.*")
    best = written(least, "quality-least")
    release(estimate)
    return best


def judge(documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", cutoff: float = CUTOFF, keep_text: bool = True) -> DataFrame:
    """The rows with their statistics, ``base_failed``, ``distance`` and ``kept`` added (see ADDED); without the text if ``keep_text`` is false.

    Estimates come from rows that pass the fixed limits. Groups of fewer than 50 such rows share an estimate per language. Null languages
    and sources count as empty. A null or empty text fails the fixed limits; repeated rows are judged alike, each on its own. Columns of the input
    with the name of an added one are replaced; other names cannot clash, as the input travels as one struct. An empty table gives an empty one.
    """
    carried = [c for c in documents.columns if c not in ADDED and (keep_text or c != text)]
    stats = documents.select(F.struct(*[F.col(c) for c in carried]).alias("_row"), F.coalesce(F.col(lang), F.lit("")).alias("_lang"),
                             F.coalesce(F.col(source), F.lit("")).alias("_source"), F.explode(F.array(text_statistics(F.col(text)))).alias("_s"))
    stats = stats.select("_row", "_lang", "_source", "_s.*").withColumn("base_failed", base_failed())
    # The statistics are written, so that no step computes them again.
    keyed = written(stats.select("*", *features()), "quality-rows")
    fit = keyed.where(~F.col("base_failed")).select("_lang", "_source", *FEATURES)
    shared = F.when(F.col("rows") >= MIN_ROWS, F.concat(F.lit("="), F.col("_source"))).otherwise("*")
    sizes = written(keyed.groupBy("_lang", "_source").agg(F.count_if(~F.col("base_failed")).alias("rows"))
                    .select("_lang", "_source", F.col("_lang").alias("lang_key"), shared.alias("source_key")), "quality-groups")
    rows = fit.join(sizes, ["_lang", "_source"]).select(*KEYS, *FEATURES)
    judged = _measured(keyed.join(sizes, ["_lang", "_source"], "left"), least_determinant(rows))
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)
    return judged.withColumn("kept", kept).select("_row.*", *ADDED)


ADDED = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept"]
