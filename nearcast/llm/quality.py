"""Quality rules with robust multivariate outliers, all as DataFrame expressions.

Base statistics are computed inside each row (whole text). Documents that pass
the two base rules are then judged by group (language and source): the minimum
covariance determinant (MCD) estimate of the transformed statistics gives a
centre and a scatter that a minority of junk cannot move, and a document whose
squared Mahalanobis distance exceeds a fixed chi-square quantile is rejected.

MCD by concentration steps from two deterministic starts (median and MAD;
tanh-weighted covariance): distances, the 75 % smallest per group (a mergeable
quantile sketch), new mean and covariance, again; the start with the smaller
determinant wins, then one reweighting step. Every step is one aggregation by
group with map-side partial sums, so a hot source is never in one task; what a
step hands on is one row per group. A scale floor per statistic is added to the
scatter, because most groups have no symbol and no repeated line at all.
Groups with fewer than ``min_group`` documents use their language's estimate,
small languages the estimate of all documents. These are fitted on all rows of
the language and on all rows, whatever estimates those rows are judged by.

Defined cases: a null or blank text has no word and fails the base rule; null
languages or sources are groups of their own; with no document left after the
base rules nothing else is rejected; repeated rows count and are judged as
often as they occur; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearcast.session import materialize

# fixed values: white space of the word rule, counted symbols, word and share limits
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

P = 4
#: Smallest scale of each transformed statistic (word length, symbols, repeated lines, repeated words).
FLOORS = (0.1, 0.5, 0.3, 0.15)
KEEP_SHARE = 0.75
#: Makes the covariance of the 75 % most central of 4-variate normal rows consistent.
CONSISTENCY = 1.487
#: Chi-square quantiles with 4 degrees of freedom: 0.975 (reweighting) and 0.999999 (rejection).
REWEIGHT_CUT, CUT = 11.143, 33.377
STEPS = 4


def base_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of one row's text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", F.col("lang").alias("lang"), F.col("source").alias("source"), text.alias("t"))
    d = d.withColumn("trimmed", F.btrim("t", F.lit(SPACE)))
    d = d.withColumn("w", F.split("trimmed", r"[\x20\x09-\x0D]+"))
    d = d.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != ""))
    d = d.select(
        "doc_id", "lang", "source",
        F.when(F.col("trimmed") == "", F.lit(0)).otherwise(F.size("w")).cast("long").alias("n_words"),
        F.char_length(F.translate("t", SPACE, "")).cast("long").alias("word_chars"),
        (F.char_length("t") - F.char_length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").alias("n_lines"),
        "w", windows(F.col("w")).alias("s"))
    d = d.withColumn("s", compared(likely_positions()))
    d = d.withColumn("p", repeated_positions())
    return d.withColumn("n_repeat_words", covered(F.col("p"))).drop("w", "s", "p")


def windows(w: Column) -> Column:
    """Sorted (33-bit hash of a 3-word window, 31-bit position), one long each; empty below four words."""
    at = F.sequence(F.lit(0), F.size(w) - 4 + F.lit(1))
    packed = F.transform(at, lambda i: F.shiftleft(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), 31)
                         .bitwiseOR(i.cast("long")))
    return F.when(F.size(w) >= 4, F.sort_array(packed)).otherwise(F.array().cast("array<bigint>"))


def likely_positions() -> Column:
    """Positions of the windows whose hash occurs twice or more (neighbours in ``s`` share it)."""
    return F.expr("""
      transform(
        filter(sequence(0, size(s) - 1), i -> size(s) > 0 and (
          shiftright(get(s, i), 31) <=> shiftright(get(s, i - 1), 31)
          or shiftright(get(s, i), 31) <=> shiftright(get(s, i + 1), 31))),
        i -> cast(get(s, i) & 2147483647L as int))""")


def compared(at: Column) -> Column:
    """Sorted (three words, position) of the windows at the positions ``at``."""
    w = F.col("w")
    return F.sort_array(F.transform(at, lambda i: F.struct(
        F.struct(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("words"), i.alias("at"))))


def repeated_positions() -> Column:
    """Positions of the windows whose words occur twice or more, ascending (neighbours in ``s`` share the words)."""
    return F.expr("""
      sort_array(transform(
        filter(sequence(0, size(s) - 1), i -> size(s) > 0 and (
          get(s, i).words <=> get(s, i - 1).words or get(s, i).words <=> get(s, i + 1).words)),
        i -> get(s, i).at))""")


def covered(p: Column) -> Column:
    """Words in three-word windows that start at the ascending positions ``p``."""
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(p, start, lambda a, x: F.struct(
        x.alias("last"), (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n")), lambda a: a["n"])


def features() -> list[Column]:
    """Transformed statistics, none of which grows with the length of a clean text."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
            F.log1p(100 * F.col("n_symbols") / n),
            F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
            F.asin(F.sqrt(F.col("n_repeat_words") / n))]


def with_group(stats: DataFrame, min_group: int) -> DataFrame:
    """Add ``key``: language and source if that group is large enough, else language, else all; and ``fits``, the
    keys of all estimates that the row enters: those of its group, its language and all rows that some row is judged by."""
    # to_json leaves nulls out, so the kinds of keys are told apart by a word
    own = F.concat(F.lit("source "), F.to_json(F.struct("lang", "source")))
    counts = stats.where("not base_failed").groupBy("lang", "source").agg(F.count("*").alias("n"))
    counts = materialize(counts.withColumn("own", own).withColumn("of_lang", F.concat(F.lit("lang "), F.to_json(F.struct("lang")))))
    by_lang = counts.groupBy("of_lang").agg(F.sum("n").alias("n_lang"), (F.min("n") < min_group).alias("any_small"))
    by_lang = by_lang.withColumn("lang_fit", F.col("any_small") & (F.col("n_lang") >= min_group))
    all_fit = by_lang.agg(F.coalesce(F.min("n_lang") < min_group, F.lit(False)).alias("all_fit"))
    large = F.col("n") >= min_group
    keys = materialize(counts.join(by_lang, "of_lang").crossJoin(all_fit).select(
        "own", F.when(large, F.col("own")).when(F.col("n_lang") >= min_group, F.col("of_lang")).otherwise("all").alias("key"),
        F.array_compact(F.array(F.when(large, F.col("own")), F.when(F.col("lang_fit"), F.col("of_lang")),
                                F.when(F.col("all_fit"), F.lit("all")))).alias("fits")))
    return stats.withColumn("own", own).join(keys, "own", "left").drop("own")


X = [f"x{i}" for i in range(P)]
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


def moments(scale: float = 1.0) -> list[Column]:
    return [*(F.avg(x).alias(f"m{i}") for i, x in enumerate(X)),
            *((F.covar_pop(X[i], X[j]) * scale).alias(f"c{i}{j}") for i, j in PAIRS)]


def whitened(estimate: DataFrame) -> DataFrame:
    """Add ``w_ij``, the inverse Cholesky factor of each row's floored covariance, and its log determinant.

    Column by column, so that each step names earlier columns instead of
    repeating their expressions; one row per group.
    """
    for i in range(P):
        for j in range(i + 1):
            rest = F.col(f"c{j}{i}") + F.lit(FLOORS[i] ** 2 if i == j else 0.0)
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            # rounding can leave a tiny negative rest; the floor bounds a diagonal entry from below
            estimate = estimate.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(FLOORS[i] ** 2 / 4)))
                                           if i == j else rest / F.col(f"l{j}{j}"))
    for i in range(P):
        for j in range(i):
            rest = sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0))
            estimate = estimate.withColumn(f"w{i}{j}", -rest / F.col(f"l{i}{i}"))
        estimate = estimate.withColumn(f"w{i}{i}", 1 / F.col(f"l{i}{i}"))
    estimate = estimate.withColumn("det", sum((F.log(f"l{i}{i}") for i in range(P)), F.lit(0.0)))
    return estimate.drop(*(f"l{i}{j}" for i in range(P) for j in range(i + 1)))


def squared_distance() -> Column:
    """Squared Mahalanobis distance of x0.. from a whitened estimate in the same row."""
    total = F.lit(0.0)
    for i in range(P):
        y = sum(((F.col(X[j]) - F.col(f"m{j}")) * F.col(f"w{i}{j}") for j in range(i + 1)), F.lit(0.0))
        total = total + y * y
    return total


def mcd(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """key, m0.., c00..: the reweighted MCD estimate of each key of ``rows`` (key, x0..x3)."""
    median = materialize(rows.groupBy("key").agg(*(F.percentile_approx(x, 0.5).alias(f"m{i}") for i, x in enumerate(X))))
    spread = materialize(rows.join(median, "key").groupBy("key").agg(
        *(F.first(f"m{i}").alias(f"m{i}") for i in range(P)),
        *((1.4826 * F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5)).alias(f"s{i}") for i, x in enumerate(X))))
    tanh = [F.tanh((F.col(X[i]) - F.col(f"m{i}")) / F.greatest(F.col(f"s{i}"), F.lit(FLOORS[i]))) for i in range(P)]
    bent = rows.join(spread, "key").groupBy("key").agg(
        *(F.first(f"m{i}").alias(f"m{i}") for i in range(P)),
        *((F.covar_pop(tanh[i], tanh[j]) * F.first(F.greatest(F.col(f"s{i}"), F.lit(FLOORS[i])))
           * F.first(F.greatest(F.col(f"s{j}"), F.lit(FLOORS[j])))).alias(f"c{i}{j}") for i, j in PAIRS))
    plain = spread.select("key", *(f"m{i}" for i in range(P)),
                          *((F.col(f"s{i}") ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS))
    estimate = materialize(whitened(plain.withColumn("start", F.lit(0)).unionByName(bent.withColumn("start", F.lit(1)))))
    for _ in range(steps):
        far = rows.join(estimate, "key").withColumn("d2", squared_distance())
        limits = materialize(far.groupBy("key", "start").agg(
            F.percentile_approx("d2", KEEP_SHARE, F.lit(1000)).alias("limit")))
        near = rows.join(estimate.join(limits, ["key", "start"]), "key").where(squared_distance() <= F.col("limit"))
        estimate = materialize(whitened(near.groupBy("key", "start").agg(*moments(CONSISTENCY))))
    best = estimate.groupBy("key").agg(
        F.min_by(F.struct(*(c for c in estimate.columns if c != "key")), F.struct("det", "start")).alias("e"))
    best = materialize(best.select("key", "e.*").drop("start"))
    return materialize(whitened(rows.join(best, "key").where(squared_distance() <= REWEIGHT_CUT)
                                .groupBy("key").agg(*moments())))


def quality_rules(docs: DataFrame, min_group: int = 100, cut: float = CUT) -> DataFrame:
    """One row per row of ``docs``: counts, ``base_failed``, ``kept`` and the squared distance ``d2``."""
    stats = base_statistics(docs).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    stats = materialize(stats.select("*", *(f.alias(x) for f, x in zip(features(), X, strict=True))))
    stats = with_group(stats, min_group)
    estimate = mcd(stats.where("not base_failed").select(F.explode("fits").alias("key"), *X))
    judged = stats.join(estimate, "key", "left").withColumn("d2", F.when(~F.col("base_failed"), squared_distance()))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("d2") <= cut, F.lit(True))).alias("kept"), "d2", "lang", "source")


def passing(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns."""
    stats = docs.withColumn("doc_id", F.struct("doc_id", F.xxhash64("text").alias("th")))
    good = quality_rules(stats).where("kept").select(
        F.col("doc_id.doc_id").alias("__id"), F.col("doc_id.th").alias("__th"), F.col("lang").alias("__lang"), F.col("source").alias("__source"))
    return docs.join(good, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__th"))
                     & F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")), "left_semi")
