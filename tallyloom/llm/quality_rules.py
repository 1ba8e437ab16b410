"""Quality rules whose cutoffs are certified on labelled rows.

For each rule, group of rows (stratum) and cutoff of a fixed list, the labelled good rows above the
cutoff are counted. The cutoff is safe if so few of them could be there by chance with a probability
of ``doubt`` at most, were the true share above it larger than ``risk``: an exact binomial tail.
Cutoffs are tried from the loosest on and the first failure ends the search, so that one test's doubt
covers a whole list; rules and strata share the doubt evenly (Bonferroni), and the rules share the risk.
So with confidence ``1 - doubt`` no stratum loses more than ``risk`` of its good rows to the rules.

Nothing is learned from the labels but this choice, so all labelled rows serve as the holdout. Only
DataFrame functions are used.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK, WORD, stage, text_or_empty

RISK = 0.02
DOUBT = 0.05
SPAN = 5
#: Cutoffs per rule, loosest first; a row fails a rule above its cutoff.
RULES: dict[str, tuple[float, ...]] = {
    "symbol_ratio": (0.8, 0.5, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02),
    "upper_ratio": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "dup_line_ratio": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
    "repeat_ratio": (0.2, 0.175, 0.15, 0.125, 0.1, 0.075, 0.05),
    "mean_word": (40.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0, 10.0),
}
#: Terms of a binomial tail that are added one by one; a bound stands for the rest.
TERMS = 1000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column, span: int = SPAN) -> Column:
    """Words inside windows of ``span`` words that the text holds twice or more."""

    def covered(windows: Column) -> Column:
        marked = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def count(s: Column) -> Column:
            before = lambda k: F.coalesce(F.get(s, k - 1)["h"], F.lit(None).cast("long"))
            after = lambda k: F.get(s, k + 1)["h"]
            twice = F.filter(s, lambda e, k: (F.coalesce(before(k) == e["h"], F.lit(False))) | (F.coalesce(after(k) == e["h"], F.lit(False))))
            starts = F.sort_array(F.transform(twice, lambda e: e["i"]))
            steps = lambda p: F.transform(p, lambda v, k: F.least(F.lit(span), F.coalesce(F.get(p, k + 1) - v, F.lit(span))))
            return _let(starts, lambda p: F.aggregate(steps(p), F.lit(0), lambda a, x: a + x))

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_let(marked, count))

    def windows_of(h: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(h) - span)
        return F.transform(places, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(span)]))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < span, F.lit(0)).otherwise(_let(hashed, lambda h: _let(windows_of(h), covered)))


def text_measures(text: Column) -> Column:
    """A struct of counts of a text: ``n_words, word_chars, n_symbols, n_upper, n_lines, n_dup_lines,
    n_repeat_words``."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), 1)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{BLANK}]"))
    by_word = _let(words, lambda w: F.struct(F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"), repeated_words(w).alias("n_repeat_words")))
    by_line = _let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    return F.struct(by_word.alias("w"), by_line.alias("l"), F.regexp_count(text, F.lit("[#*$%&|<>]")).alias("n_symbols"), F.regexp_count(text, F.lit("[A-Z]")).alias("n_upper"))


#: Names that ``measured`` and ``ruled`` give.
RESULTS = (
    "n_words", "word_chars", "n_repeat_words", "n_lines", "n_dup_lines", "n_symbols", "n_upper", "base_failed",
    "symbol_ratio", "upper_ratio", "dup_line_ratio", "repeat_ratio", "mean_word", "kept",
)


def measured(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` but the text, the counts as ``long``, ``base_failed`` and the rules'
    values. A null text is empty. A column of ``docs`` with a result's name, or one that begins with two
    underscores, gives way."""
    rest = [c for c in docs.columns if c not in ("text", *RESULTS) and not c.startswith("__")]
    rows = docs.select(*[F.col(f"`{c}`") for c in rest], text_measures(text_or_empty()).alias("__m"))
    counts = {"n_words": "w", "word_chars": "w", "n_repeat_words": "w", "n_lines": "l", "n_dup_lines": "l", "n_symbols": None, "n_upper": None}
    rows = rows.select(*[F.col(f"`{c}`") for c in rest], *[F.col(f"__m.{p + '.' if p else ''}{c}").cast("long").alias(c) for c, p in counts.items()])
    over = lambda a, b: F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1)).cast("double")
    return rows.withColumns(
        {
            "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
            "symbol_ratio": over("n_symbols", "word_chars"),
            "upper_ratio": over("n_upper", "word_chars"),
            "dup_line_ratio": over("n_dup_lines", "n_lines"),
            "repeat_ratio": over("n_repeat_words", "n_words"),
            "mean_word": over("word_chars", "n_words"),
        }
    )


def log_factorial(n: Column) -> Column:
    """Natural logarithm of n!; by Stirling's series from 20 on, where it is exact to the last digits."""
    x = F.greatest(n, F.lit(20)).cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    return F.when(n < 20, F.log(F.factorial(F.least(n, F.lit(19)).cast("int")).cast("double"))).otherwise(series)


def binomial_tail(k: Column, n: Column, p: float, terms: int = TERMS) -> Column:
    """The probability of ``k`` or fewer of ``n`` at rate ``p``; never below it. 1 above the mean."""
    log_top = log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * math.log(p) + (n - k) * math.log(1 - p)
    steps = F.sequence(F.lit(0), F.least(k, F.lit(terms)).cast("int"))
    # Each term is the one above it times i (1 - p) / ((n - i + 1) p).
    ratio = lambda i: i * (1 - p) / ((n - i + 1) * p)
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term"))
    added = F.aggregate(steps, start, lambda a, j: F.struct((a["sum"] + a["term"]).alias("sum"), (a["term"] * ratio(k - j)).alias("term")))
    last = ratio(k - terms)
    rest = F.when(k > terms, added["term"] / (1 - last)).otherwise(F.lit(0.0))
    return F.when(k > n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(log_top) * (added["sum"] + rest)))


def safe_cutoffs(rows: DataFrame, good: Column, stratum: str, rules: dict[str, Sequence[float]] = RULES, risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """Per stratum and rule the strictest certified cutoff: ``stratum, rule, cutoff, n, above``.

    Strata and rules without one are absent. One pass counts all cutoffs at once.
    """
    rules = {r: sorted(c, reverse=True) for r, c in rules.items()}
    held = rows.filter(good)
    above = {f"{r}_{i}": F.sum((F.col(r) > c).cast("long")) for r, cs in rules.items() for i, c in enumerate(cs)}
    counts = held.groupBy(F.col(stratum).alias("stratum")).agg(F.count("*").alias("n"), *[v.alias(k) for k, v in above.items()])
    listed = [F.struct(F.lit(r).alias("rule"), F.lit(i).alias("step"), F.lit(float(c)).alias("cutoff"), F.col(f"{r}_{i}").alias("above")) for r, cs in rules.items() for i, c in enumerate(cs)]
    # Strata are counted by a window over one row each.
    counts = counts.withColumn("tests", F.count("*").over(Window.partitionBy(F.lit(0))) * len(rules))
    tests = counts.select("stratum", "n", "tests", F.explode(F.array(*listed)).alias("t")).select("stratum", "n", "tests", "t.*")
    tail = binomial_tail(F.col("above"), F.col("n"), risk / len(rules))
    so_far = Window.partitionBy("stratum", "rule").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    passed = tests.withColumn("safe", F.min((tail <= F.lit(doubt) / F.col("tests")).cast("int")).over(so_far) == 1)
    return passed.filter("safe").groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"), F.first("n").alias("n"), F.max("above").alias("above"))


def ruled(docs: DataFrame, labels: DataFrame, stratum: str = "lang", label: str = "quality", **options) -> DataFrame:
    """``measured(docs)`` with ``kept``: neither failed at base nor above a certified cutoff.

    Good rows are those whose id has the label 1 and no other. Strata without enough labelled rows
    have no cutoffs, and their rows are kept.
    """
    rows = stage(measured(docs), "measures")
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.min(label) == 1).alias("__good")).filter("__good")
    rules = options.get("rules", RULES)
    cutoffs = safe_cutoffs(rows.join(known, "doc_id"), F.col("__good"), stratum, **options)
    wide = cutoffs.groupBy(F.col("stratum").alias("__stratum")).agg(*[F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"__{r}") for r in rules])
    out = rows.join(wide, F.col(stratum).eqNullSafe(F.col("__stratum")), "left")
    fails = F.lit(False)
    for r in rules:
        fails = fails | F.coalesce(F.col(r) > F.col(f"__{r}"), F.lit(False))
    return out.select(*rows.columns, (~F.col("base_failed") & ~fails).alias("kept"))
