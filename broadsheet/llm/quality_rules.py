"""Quality rules whose cutoffs carry a statistical guarantee (native expressions only).

Every document gets four base measures and four signals. For each stratum (language) and signal a
grid of cutoffs is tested on a labelled holdout: among the ``n`` documents labelled good, ``k`` would
be rejected. A cutoff is admitted when the exact binomial tail ``P(Bin(n, risk) <= k)`` is at most
``delta`` divided by the number of tests (Bonferroni over strata, signals and cutoffs), that is, when
the Clopper-Pearson upper bound of its false-rejection rate stays under ``risk``. The lowest admitted
cutoff wins; where none is admitted the signal rejects nothing. The overall false-rejection risk of a
stratum is split evenly over the signals, so with probability ``1 - delta`` no stratum loses more than
``max_false_rejection`` of its good documents to the signals.

Defined results: a null or empty text has no words and fails the base rule; a null language is a
stratum of its own; labels of unknown documents, null labels and null ids calibrate nothing; repeated
rows are judged alike. Extra columns pass through untouched, but for
ones named _quality, _kept, _stratum or _cut_ and a signal, which are replaced or removed.
Two three-word windows count as equal when their chained 64-bit hashes are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.expr import let
from broadsheet.session import cut

SIGNALS = ("symbol_ratio", "repeat_ratio", "dup_line_ratio", "upper_ratio")
CUTOFFS = (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.75, 0.9)
_WORD = r"[^\x20\x09-\x0D]+"
#: The thresholds are broadcast: strata * signals rows. More strata than this are refused.
MAX_STRATA = 10_000


def _repeat_words(words: Column) -> Column:
    """Words covered by three-word windows that occur twice or more."""

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            last = F.size(s) - 1
            twin = F.filter(
                F.sequence(F.lit(0), last),
                lambda j: ((j > 0) & (s[F.greatest(j - 1, F.lit(0))]["h"] == s[j]["h"]))
                | ((j < last) & (s[F.least(j + 1, last)]["h"] == s[j]["h"])),
            )
            return F.array_sort(F.transform(twin, lambda j: s[j]["i"]))

        def total(p: Column) -> Column:
            last = F.size(p) - 1
            return F.aggregate(
                F.sequence(F.lit(0), last),
                F.lit(0),
                lambda acc, j: acc + F.when(j == last, F.lit(3)).otherwise(F.least(F.lit(3), p[F.least(j + 1, last)] - p[j])),
            )

        return let(let(pairs, positions), total)

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(
        let(
            let(words, windows),
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)),
        )
    )


def measures(text: Column) -> Column:
    """Struct of the base measures and the signals of one text."""
    text = F.coalesce(text, F.lit(""))

    def of(t: Column) -> Column:
        def with_words(w: Column) -> Column:
            lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(_WORD))

            def with_lines(ls: Column) -> Column:
                def ratio(a: Column, b: Column) -> Column:
                    return a / F.greatest(b, F.lit(1))

                base = F.struct(
                    F.size(w).cast("long").alias("n_words"),
                    F.length(F.regexp_replace(t, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
                    (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
                    (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
                    _repeat_words(w).cast("long").alias("n_repeat_words"),
                    F.size(ls).cast("long").alias("n_lines"),
                    (F.length(t) - F.length(F.regexp_replace(t, "[A-Z]+", ""))).cast("long").alias("n_upper"),
                )
                return let(
                    base,
                    lambda b: F.struct(
                        *[b[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                        ((b["n_words"] < 50) | (b["n_repeat_words"] * 100 > b["n_words"] * 50)).alias("base_failed"),
                        ratio(b["n_symbols"], b["word_chars"]).alias("symbol_ratio"),
                        ratio(b["n_repeat_words"], b["n_words"]).alias("repeat_ratio"),
                        ratio(b["n_dup_lines"], b["n_lines"]).alias("dup_line_ratio"),
                        ratio(b["n_upper"], b["word_chars"]).alias("upper_ratio"),
                    ),
                )

            return let(lines, with_lines)

        return let(F.regexp_extract_all(t, F.lit(_WORD), F.lit(0)), with_words)

    return let(text, of)


def binomial_tail(k: Column, n: Column, risk: float) -> Column:
    """P(Bin(n, risk) <= k), summed from k downwards relative to the largest term.

    Exact up to rounding: terms are added until they are far below the smallest that matters, twelve
    standard deviations under k. At or above the mean the tail is not small, and 1 is returned.
    """
    log_odds, log_keep = math.log(risk) - math.log1p(-risk), math.log1p(-risk)

    def log_gamma(x: Column) -> Column:
        # Stirling's series after shifting the argument by eight.
        y = x + 8
        shift = sum((F.log(x + i) for i in range(1, 8)), F.log(x))
        series = 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5)) - 1 / (1680 * F.pow(y, 7))
        return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift

    n, k = n.cast("double"), k.cast("double")
    log_top = log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * log_odds + n * log_keep
    terms = F.least(k, F.ceil(12 * F.sqrt(n * risk * (1 - risk))) + 60).cast("int")
    zero = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(acc: Column, j: Column) -> Column:
        down = k - j + 1  # the ratio of P(X = down - 1) to P(X = down)
        term = acc["term"] * down / ((n - down + 1) * math.exp(log_odds))
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    rest = F.when(terms < 1, F.lit(1.0)).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.greatest(terms, F.lit(1))), zero, step, lambda acc: acc["sum"])
    )
    return F.when((n < 1) | (k >= n * risk), F.lit(1.0)).otherwise(F.exp(log_top + F.log(rest)))


def thresholds(measured: DataFrame, labels: DataFrame, max_false_rejection: float = 0.05, delta: float = 0.05) -> DataFrame:
    """Lowest admitted cutoff per stratum and signal: columns _stratum and one per signal (null: unused).

    ``measured`` has doc_id, _stratum and _quality; ``labels`` has doc_id and quality (1 is good).
    Good documents that the base rule already rejects are no holdout of the signals.
    """
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_good_id")).distinct()
    held = (
        measured.filter("doc_id IS NOT NULL")
        .select(F.col("doc_id").alias("_id"), "_stratum", *[F.col(f"_quality.{s}").alias(s) for s in SIGNALS], F.col("_quality.base_failed").alias("_failed"))
        .join(good, F.col("_id") == F.col("_good_id"), "left_semi")
        .filter(~F.col("_failed"))
    )
    counts = held.groupBy("_stratum").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.when(F.col(s) >= c, 1)).alias(f"{s}_{i}") for s in SIGNALS for i, c in enumerate(CUTOFFS)],
    )
    tests = F.explode(F.array(*[
        F.struct(F.lit(s).alias("signal"), F.lit(c).alias("cutoff"), F.col(f"{s}_{i}").alias("k"))
        for s in SIGNALS for i, c in enumerate(CUTOFFS)
    ]))
    rows = counts.select("_stratum", "n", tests.alias("t")).select("_stratum", "n", "t.*")
    n_tests = counts.agg((F.count(F.lit(1)) * len(SIGNALS) * len(CUTOFFS)).alias("n_tests"))
    admitted = rows.join(F.broadcast(n_tests)).filter(
        binomial_tail(F.col("k"), F.col("n"), max_false_rejection / len(SIGNALS)) <= delta / F.col("n_tests")
    )
    return admitted.groupBy("_stratum").agg(*[F.min(F.when(F.col("signal") == s, F.col("cutoff"))).alias(f"_cut_{s}") for s in SIGNALS])


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", max_false_rejection: float = 0.05, delta: float = 0.05) -> DataFrame:
    """``docs`` with ``_quality`` (measures) and ``_kept``; columns given are the ones kept beside the verdict."""
    measured = cut(
        docs.drop(*[f"_cut_{s}" for s in SIGNALS]).withColumns({"_stratum": F.coalesce(F.col(stratum).cast("string"), F.lit("\x00")), "_quality": measures(F.col("text"))}),
        "quality",
    )
    return _verdict(measured, labels, max_false_rejection, delta)


def judge_ids(docs: DataFrame, labels: DataFrame, stratum: str = "lang", max_false_rejection: float = 0.05, delta: float = 0.05) -> DataFrame:
    """As :func:`judge`, but only ids and measures are written and returned, never texts."""
    measured = cut(
        docs.select(
            "doc_id", F.coalesce(F.col(stratum).cast("string"), F.lit("\x00")).alias("_stratum"), measures(F.col("text")).alias("_quality")
        ),
        "quality",
    )
    return _verdict(measured, labels, max_false_rejection, delta)


def _verdict(measured: DataFrame, labels: DataFrame, max_false_rejection: float, delta: float) -> DataFrame:
    cuts = cut(thresholds(measured, labels, max_false_rejection, delta), "cutoffs")
    if cuts.limit(MAX_STRATA + 1).count() > MAX_STRATA:
        raise ValueError(f"more than {MAX_STRATA} strata; choose a coarser stratum column")
    hit = [F.coalesce(F.col(f"_quality.{s}") >= F.col(f"_cut_{s}"), F.lit(False)) for s in SIGNALS]
    rejected = hit[0] | hit[1] | hit[2] | hit[3]
    return (
        measured.join(F.broadcast(cuts), "_stratum", "left")
        .withColumn("_kept", ~F.col("_quality.base_failed") & ~rejected)
        .drop("_stratum", *[f"_cut_{s}" for s in SIGNALS])
    )
