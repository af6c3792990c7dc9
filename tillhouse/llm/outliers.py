"""Quality rules: robust multivariate outliers per language and source.

Each text becomes a few statistics, each language and source a centre and a covariance
fitted by minimum covariance determinant: from a robust start, concentration steps keep
the three quarters of the documents that are nearest and fit again, which never raises
the determinant. A last step fits all that are within the usual distance of that.
A text is rejected when its Mahalanobis distance is beyond what one in ten thousand of a
normal population would show. Plain limits reject a few texts before that.

All of it is DataFrame expressions; per step, rows are reduced to sums and to a
histogram of distances per group before anything is shuffled, so a group may be of any size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.common import BLANK_RUN, BLANKS, WORD, cut

WINDOW = 8
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATS = [*BASE, "n_lines"]
#: Transformed statistics are kept as whole thousandths: sums over them are exact, so
#: the fit does not depend on the order of rows.
UNIT = 1000.0
#: Spread that a statistic has at least, given those before it. Most texts have no symbol or
#: repeated line at all, and without it the first one would be infinitely far out. The
#: last three lie between 0 and 1: alone, a quarter of symbols or a sixth of repeated lines is too far.
FLOORS = (0.25, 0.1, 0.1, 0.08, 0.08)
#: Tail of the normal population that the last step of the fit leaves out.
TRIM = 0.025
P = len(FLOORS)
BINS_PER_DOUBLING = 32


# --- statistics of a text ------------------------------------------------------


def text_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with `STATS` added, from whole texts; null is no text at all.

    Columns of these names that are there already are replaced.
    """
    own = ["_text", "_words", "_lines", "_grams", "_sorted", "_starts"]
    text, words, lines, grams, ordered, starts = map(F.col, own)
    trimmed = F.btrim(text, F.lit(BLANKS))
    rows = docs.drop(*STATS).withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    rows = rows.withColumns({
        "_words": F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN)),
        "_lines": F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)),
    })
    rows = rows.withColumns({
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "_grams": F.when(
            F.size(words) >= WINDOW,
            F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW))),
        ),
    })
    # Most texts repeat no window, and for them nothing is sorted.
    repeats = F.size(F.array_distinct(grams)) < F.size(grams)
    rows = rows.withColumn(
        "_sorted",
        F.when(repeats, F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))),
    )
    same = lambda j, x: F.coalesce(F.get(ordered, j)["g"] == x["g"], F.lit(False))
    rows = rows.withColumn(
        "_starts",
        F.sort_array(F.transform(
            F.filter(ordered, lambda x, j: same(j - 1, x) | same(j + 1, x)), lambda x: x["i"]
        )),
    )
    # Windows that overlap cover words once: each adds the words up to the next one.
    covered = F.aggregate(
        F.transform(starts, lambda s, j: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - s, F.lit(WINDOW)))),
        F.lit(0), lambda sum_, n: sum_ + n,
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(*own)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _features() -> list[Column]:
    """Transformed statistics, in thousandths."""
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    raw = [
        F.log1p("n_words"),
        F.log(chars / n),
        F.sqrt(F.col("n_symbols") / chars),
        F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))),
        F.sqrt(F.col("n_repeat_words") / n),
    ]
    return [F.round(x * UNIT).cast("long").alias(f"x{i}") for i, x in enumerate(raw)]


# --- chi-square ----------------------------------------------------------------


def chi2_cdf(k: int, x: float) -> float:
    """The series of the regularised gamma function."""
    a, z = k / 2, x / 2
    term = total = 1 / a
    step = 0
    while term > 1e-17 * total:
        step += 1
        term *= z / (a + step)
        total += term
    return total * math.exp(a * math.log(z) - z - math.lgamma(a)) if z > 0 else 0.0


def chi2_quantile(k: int, tail: float) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if 1 - chi2_cdf(k, middle) > tail else (low, middle)
    return high


# --- groups --------------------------------------------------------------------


def group_keys(stats: DataFrame, min_rows: int, lang_col: str, source_col: str) -> DataFrame:
    """`g_lang, g_source, grp`: the group of each language and source.

    Sources with few rows share one group per language, languages with few rows in
    that share one for all.
    """
    sizes = stats.groupBy(F.col(lang_col).alias("g_lang"), F.col(source_col).alias("g_source")).agg(F.count(F.lit(1)).alias("n"))
    small = F.col("n") < min_rows
    in_lang = F.sum(F.when(small, F.col("n")).otherwise(0)).over(Window.partitionBy("g_lang"))
    part = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("null"))
    name = F.when(~small, F.concat_ws("\t", part(F.col("g_lang")), part(F.col("g_source")))).otherwise(
        F.when(in_lang >= min_rows, part(F.col("g_lang"))).otherwise(F.lit("all"))
    )
    return sizes.select("g_lang", "g_source", name.alias("grp"))


def _with_group(rows: DataFrame, groups: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    same = F.col(lang_col).eqNullSafe(F.col("g_lang")) & F.col(source_col).eqNullSafe(F.col("g_source"))
    return rows.join(groups, same, "left").drop("g_lang", "g_source")


def _squared_distance(x: list[Column]) -> Column:
    """The squared Mahalanobis distance by the group's `m` and `w`.

    `w` holds the rows of the inverse Cholesky factor one after the other.
    """
    parts, at = [], 0
    for i in range(P):
        parts.append(sum((F.col("w")[at + j] * (x[j] / UNIT - F.col("m")[j]) for j in range(i + 1)), F.lit(0.0)))
        at += i + 1
    return sum((y * y for y in parts), F.lit(0.0))


def _distance(rows: DataFrame, shape: DataFrame) -> DataFrame:
    return rows.join(shape, "grp").withColumn("d2", _squared_distance([F.col(f"x{i}") for i in range(P)]))


def _shape_of(moments: DataFrame, scale: float) -> DataFrame:
    """`grp, m, w, log_det` from counts and sums, with the floors below the conditional spreads."""
    n = F.col("n").cast("double")
    mean = [F.col(f"s{i}").cast("double") / n / UNIT for i in range(P)]
    rows = moments.select("grp", F.array(*mean).alias("m"), *[
        (scale * (F.col(f"s{i}_{j}").cast("double") / n / UNIT / UNIT - mean[i] * mean[j])).alias(f"c{i}_{j}")
        for i in range(P) for j in range(i + 1)
    ])
    c = lambda kind, i, j: F.col(f"{kind}{i}_{j}")
    for j in range(P):  # Cholesky factor, column by column
        left = c("c", j, j) - sum((c("l", j, k) * c("l", j, k) for k in range(j)), F.lit(0.0))
        rows = rows.withColumn(f"l{j}_{j}", F.sqrt(F.greatest(left, F.lit(FLOORS[j] ** 2))))
        for i in range(j + 1, P):
            dot = sum((c("l", i, k) * c("l", j, k) for k in range(j)), F.lit(0.0))
            rows = rows.withColumn(f"l{i}_{j}", (c("c", i, j) - dot) / c("l", j, j))
    for i in range(P):  # its inverse, row by row
        rows = rows.withColumn(f"w{i}_{i}", 1 / c("l", i, i))
        for j in range(i):
            dot = sum((c("l", i, k) * c("w", k, j) for k in range(j, i)), F.lit(0.0))
            rows = rows.withColumn(f"w{i}_{j}", -dot / c("l", i, i))
    w = F.array(*[c("w", i, j) for i in range(P) for j in range(i + 1)])
    log_det = sum((2 * F.log(c("l", i, i)) for i in range(P)), F.lit(0.0))
    return rows.select("grp", "m", w.alias("w"), log_det.alias("log_det"))


def _moments(rows: DataFrame) -> DataFrame:
    x = [F.col(f"x{i}").cast("decimal(20,0)") for i in range(P)]
    return rows.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(x[i]).alias(f"s{i}") for i in range(P)],
        *[F.sum((F.col(f"x{i}") * F.col(f"x{j}")).cast("decimal(20,0)")).alias(f"s{i}_{j}") for i in range(P) for j in range(i + 1)],
    )


def _nearest(rows: DataFrame, share: float) -> DataFrame:
    """The rows of each group up to the distance that `share` of them are within.

    From a histogram of distances; a bin is a few per cent wide and taken whole.
    """
    binned = rows.withColumn("bin", F.floor(F.log2(F.col("d2") + 1e-9) * BINS_PER_DOUBLING))
    counts = binned.groupBy("grp", "bin").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("grp").orderBy("bin")
    whole = Window.partitionBy("grp")
    limits = (
        counts.withColumn("below", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(whole))
        .where(F.col("below") >= share * F.col("all")).groupBy("grp").agg(F.min("bin").alias("limit"))
    )
    return binned.join(limits, "grp").where(F.col("bin") <= F.col("limit"))


def fit(stats: DataFrame, min_rows: int = 50, share: float = 0.75, steps: int = 4, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """`g_lang, g_source, m, w` per language and source: centre and inverse factor of its group.

    `stats` has `STATS`, language and source, and should be a written table. Only rows
    that pass the base limits are fitted. A group under `min_rows` after pooling is not
    fitted: nothing in it is rejected.
    """
    sound = stats.where(~base_failed())
    groups = cut(group_keys(sound, min_rows, lang_col, source_col), "outlier_groups")
    rows = _with_group(sound.select(lang_col, source_col, *_features()), groups, lang_col, source_col)
    rows = cut(rows.select("grp", *[f"x{i}" for i in range(P)]), "outlier_features")
    # Start: each statistic by its own median and quartiles. Thousandths have few
    # distinct values, so exact quantiles stay small.
    quartiles = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), *[
        F.percentile(f"x{i}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}") for i in range(P)
    ]).where(F.col("n") >= min_rows)
    spread = [F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349 / UNIT, F.lit(FLOORS[i])) for i in range(P)]
    shape = quartiles.select(
        "grp", F.array(*[F.col(f"q{i}")[1] / UNIT for i in range(P)]).alias("m"),
        F.array(*[1 / spread[i] if i == j else F.lit(0.0) for i in range(P) for j in range(i + 1)]).alias("w"),
    )
    # The nearest part of a normal population shows less than its spread.
    scale = share / chi2_cdf(P + 2, chi2_quantile(P, 1 - share))
    for step in range(steps):
        near = _nearest(_distance(rows, shape), share)
        shape = cut(_shape_of(_moments(near), scale), f"outlier_shape_{step}")
    # Reweighting: all rows within the usual distance count, not the nearest part only.
    usual = chi2_quantile(P, TRIM)
    within = _distance(rows, shape).where(F.col("d2") <= usual)
    shape = cut(_shape_of(_moments(within), (1 - TRIM) / chi2_cdf(P + 2, usual)), "outlier_shape_last")
    # Written, so that its size is known where it is joined with texts.
    return cut(groups.join(shape, "grp", "left").select("g_lang", "g_source", "m", "w"), "outlier_fit")


def judge(stats: DataFrame, known: DataFrame, tail: float = 1e-4, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows with `base_failed`, `distance` (null where not fitted) and `kept`.

    `stats` has `STATS`; `known` is what `fit` gave. Null languages and sources are groups
    like others, rows may repeat, and columns of the names added are replaced.
    """
    rows = stats.drop("base_failed", "distance", "kept")
    same = F.col(lang_col).eqNullSafe(F.col("g_lang")) & F.col(source_col).eqNullSafe(F.col("g_source"))
    d2 = _squared_distance(_features())
    far = F.coalesce(d2 > chi2_quantile(P, tail), F.lit(False))
    return rows.join(known, same, "left").select(*rows.columns, base_failed().alias("base_failed"), F.sqrt(d2).alias("distance"), (~base_failed() & ~far).alias("kept"))
