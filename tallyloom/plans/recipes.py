"""Composite analyses. Each is a short composition of operators with its contract as arguments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.frames import filter_codes, filter_prefix, filter_regex, first_present
from ..functions.numeric import clean_number, ratio, relative_difference, to_number, valid_weight
from ..functions.recode import band, calendar_factor, label_rank, premium_adjusted_rate, recode, strip_prefix_int
from ..functions.text import normalize_code
from ..operators import estimators as E
from ..operators.gates import FAIL, PASS, SKIP, Gate, gate_rows, implicates_gate, merge_gates, one_to_one_gate, run_gates
from ..operators.joins import attach_totals, cross_source_pair, measure_self_join, with_one_row
from ..operators.ordering import median_unweighted, quantile_groups_midpoint, quantile_groups_right_edge
from ..operators.replicate_groups import replicate_quantile_group_means
from ..operators.series import (
    append_series,
    asof_baseline,
    baseline_latest_summary,
    days_since,
    index_to_baseline,
    latest_per_group,
    top_k,
)
from ..operators.uncertainty import (
    Replicates,
    Z90,
    Z95,
    binomial_se,
    combine_imputations,
    linearized_se,
    margin_of_error,
    with_ci,
)


# --- survey estimates ----------------------------------------------------------------------------


def cost_burden(
    households: DataFrame,
    design: Replicates,
    *,
    code: str,
    groups: Mapping[str, str],
    income: str,
    monthly_cost: str,
    poverty: str,
    edges: Sequence[float],
    bands: Sequence[str],
    poverty_range: tuple[float, float],
    universe: Column,
    threshold: float = 0.5,
    published: Sequence[str] = (),
) -> DataFrame:
    """Share of households whose yearly cost exceeds a share of income, by poverty band and
    group, with replicate standard errors and intervals clamped to [0, 1]."""
    coded = households.withColumns(
        {
            "group": recode(normalize_code(code), groups),
            "poverty_band": band(poverty, edges, bands),
            "severe": (ratio(F.col(monthly_cost) * F.lit(12.0), income) > F.lit(threshold)).cast("double"),
        }
    )
    valid = coded.filter(
        universe
        & (F.col(income) > 0)
        & F.col(poverty).between(*poverty_range)
        & (F.col(monthly_cost) >= 0)
        & valid_weight(design.full)
        & F.col("group").isNotNull()
    )
    table = design.estimate(
        valid,
        lambda w: E.weighted_mean("severe", w),
        ["poverty_band", "group"],
        ["severe"],
        unweighted_households=lambda w: F.count(F.lit(1)),
        weighted_households=F.sum,
    )
    out = with_ci(table, Z95, 0.0, 1.0).withColumn("published", F.col("group").isin(*published))
    return out.orderBy(label_rank("poverty_band", bands), "group")


def total_benchmark(
    df: DataFrame, design: Replicates, universe: Column, expected: float, expected_moe: float, tolerance: float,
    divisor: float = 1000.0, z: float = Z90,
) -> DataFrame:
    """Gate rows for a universe total and its margin of error."""
    total = design.estimate(df.filter(universe), lambda w: F.sum(w) / F.lit(divisor), [], [])
    return gate_rows(
        total,
        [
            Gate("benchmark_total", F.col("estimate"), "absolute", expected, tolerance),
            Gate("benchmark_margin_of_error", margin_of_error("standard_error", z), "absolute", expected_moe, tolerance),
        ],
    )


def spending_by_quantile(
    families: DataFrame,
    design: Replicates,
    *,
    income: str,
    spending: str,
    tie: str,
    cuts: Sequence[float],
    labels: Sequence[str],
) -> DataFrame:
    """Weighted mean spending and income by weighted quantile group of income."""
    grouped = quantile_groups_right_edge(families, income, design.full, tie, cuts, out="group_no")
    table = design.estimate(
        grouped,
        lambda w: E.weighted_mean(spending, w),
        ["group_no"],
        [spending, income],
        mean_income=lambda w: E.weighted_mean(income, w),
        unweighted_n=lambda w: F.count(F.lit(1)),
    )
    names = {i + 1: label for i, label in enumerate(labels)}
    return with_ci(table).withColumn("quantile_group", recode("group_no", names)).orderBy("group_no")


def annual_coverage(families: DataFrame, spending: str, weight: str, periods: int, official: float, low: float, high: float) -> DataFrame:
    """Gate row: annualised mean over the published figure lies in a band."""
    one = families.agg(E.weighted_mean(spending, weight).alias("mean"))
    return gate_rows(one, [Gate("coverage_ratio", E.coverage_ratio("mean", periods, official), "band", low, high)])


def balance_by_quantile(
    summary: DataFrame,
    replicates: DataFrame,
    *,
    family: str,
    record: str,
    implicate: str,
    wealth: str,
    balance: str,
    weight: str,
    replicate_key: str,
    replicate_weights: Column,
    implicates: int,
    groups: int = 10,
) -> DataFrame:
    """Mean balance by weighted wealth group: groups and means per implicate, bootstrap variance
    on implicate 1, imputation variance between implicates."""
    assigned = quantile_groups_midpoint(
        summary.filter(clean_number(balance).isNotNull()), wealth, weight, family, groups, [implicate]
    )
    per = assigned.groupBy(implicate, "quantile_group").agg(
        E.weighted_mean(balance, weight).alias("mean"), F.sum(weight).alias("__w"), F.count(F.lit(1)).alias("__n")
    )
    counts = per.groupBy("quantile_group").agg(
        F.sum("__w").alias("weighted_households"),
        F.bround(F.sum("__n") / F.lit(float(implicates)), 0).cast("bigint").alias("unweighted_families"),
    )
    # The join takes the replicate rows as they are stored; weights made by an expression are made after it,
    # since Spark's estimate of a made array is far below its size and would have it broadcast.
    first = summary.filter(F.col(implicate) == 1).select(
        F.col(record).alias("__record"), F.col(wealth).alias("__wealth"), F.col(balance).alias("__balance"), F.col(family).alias("__family")
    )
    known = replicates.withColumns({"__key": F.col(replicate_key), "__known": F.lit(True)})
    first = first.join(known, F.col("__record") == F.col("__key"), "left")
    # A family without replicate weights would vanish from the variance, so it ends the job.
    lost = F.raise_error(F.concat(F.lit("no replicate weights for record "), F.col("__record").cast("string")))
    kind = replicates.select(replicate_weights.alias("__weights")).schema["__weights"].dataType
    weights = F.coalesce(F.when(F.col("__known"), replicate_weights), lost.cast(kind))
    means = replicate_quantile_group_means(first, "__wealth", "__balance", "__family", weights, groups)
    sampling = means.groupBy("quantile_group").agg(F.var_samp("mean").alias("variance"))
    table = combine_imputations(per, sampling, "mean", implicates, ["quantile_group"])
    return with_ci(table.join(counts, "quantile_group", "left")).orderBy("quantile_group")


def balance_gates(summary: DataFrame, replicates: DataFrame, *, family: str, record: str, implicate: str, replicate_key: str, implicates: int) -> DataFrame:
    """Gate rows that a balance by wealth group rests on: each family has every implicate once, and the first
    implicate's records meet the replicate weights one to one."""
    first = summary.filter(F.col(implicate) == 1).select(record)
    weights = replicates.select(F.col(replicate_key).alias(record))
    return merge_gates(implicates_gate(summary, family, implicate, implicates), one_to_one_gate(first, weights, record))


def spending_by_coverage(
    persons: DataFrame, group: str, spending: str, weight: str, labels: Mapping[str, str], digits: int = 2
) -> DataFrame:
    """Weighted mean with linearised standard error beside the unweighted median, by group."""
    table = with_ci(linearized_se(persons, spending, weight, [group]))
    filled = persons.withColumn(spending, F.coalesce(F.col(spending), F.lit(0.0)))
    medians = median_unweighted(filled, spending, [group])
    joined = table.join(medians, group, "left")
    rounded = {c: F.bround(c, digits) for c in ("estimate", "standard_error", "ci_low", "ci_high", "median")}
    out = joined.withColumns({**rounded, "weighted_n": F.bround("weighted_n", 0)})
    return out.withColumn(group, recode(group, labels, keep=True)).orderBy("estimate", group)


def share_by_category(
    df: DataFrame, group: str, answer: Column, weight: str, order: Sequence[str], digits: int = 4
) -> DataFrame:
    """Weighted share over all weight, binomial standard error on the unweighted count. A group
    without weight has share 0."""
    w = F.coalesce(F.col(weight), F.lit(0.0))
    hit = F.coalesce(answer, F.lit(False))
    table = df.groupBy(group).agg(
        F.coalesce(E.weighted_share(hit, w), F.lit(0.0)).alias("estimate"),
        F.count(F.lit(1)).alias("unweighted_n"),
        F.bround(F.sum(w), 0).alias("weighted_n"),
    )
    out = with_ci(table.withColumn("standard_error", binomial_se("estimate", "unweighted_n")), Z95, 0.0, 1.0)
    rounded = {c: F.bround(c, digits) for c in ("estimate", "standard_error", "ci_low", "ci_high")}
    return out.withColumns(rounded).orderBy(label_rank(group, order), group)


def calendar_year_mean(
    families: DataFrame,
    expenditures: DataFrame,
    design: Replicates,
    *,
    key: str,
    cost: str,
    month: str,
    year: str,
    selected: Column,
    reference_year: int,
) -> DataFrame:
    """Mean cost per consumer unit in a calendar year with its replicate standard error,
    population in thousands and number of reporters."""
    with_cost = attach_totals(families, expenditures.filter(selected), key, cost, "__cost")
    ready = with_cost.withColumn("__factor", calendar_factor(month, year, reference_year))
    return design.estimate(
        ready,
        lambda w: E.ratio_mean_with_denominator("__cost", w, "__factor"),
        [],
        ["__cost", "__factor"],
        population_thousands=lambda w: E.calendar_population(w, "__factor") / F.lit(1000.0),
        reporters=lambda w: E.reporters("__cost"),
    )


def calendar_year_gates(
    table: DataFrame,
    families: DataFrame,
    year: str,
    reference_year: int,
    *,
    mean: float,
    standard_error: float,
    tolerance: float,
    population_thousands: float,
    population_tolerance: float,
    reporters: int,
) -> DataFrame:
    """Gate rows of a calendar-year mean against the published table: mean, error, population, number of
    reporters, and interviews in the reference year and the next one, both and no others."""
    years = (reference_year, reference_year + 1)
    inside = F.count_distinct(F.when(F.col(year).isin(*years), F.col(year)))
    strange = F.count_if(~F.col(year).isin(*years))
    published = gate_rows(
        table,
        [
            Gate("benchmark_mean", F.col("estimate"), "absolute", mean, tolerance),
            Gate("benchmark_standard_error", F.col("standard_error"), "absolute", standard_error, tolerance),
            Gate("benchmark_population", F.col("population_thousands"), "absolute", population_thousands, population_tolerance),
            Gate("benchmark_reporters", F.col("reporters"), "equal", reporters),
        ],
    )
    return merge_gates(published, run_gates(families, [Gate("reference_years", inside, "equal", 2), Gate("other_years", strange, "equal", 0)]))


# --- macro tables --------------------------------------------------------------------------------


def event_watch(df: DataFrame, key: str, date: str, value: str, event: Column, tie: str | None = None) -> DataFrame:
    """Every observation indexed to its series' last value at or before the event."""
    based = asof_baseline(df, key, date, value, event, tie)
    return based.withColumns(
        {
            "days_since_event": days_since(F.col(date).cast("date"), event.cast("date")),
            "index": index_to_baseline(value, "baseline"),
        }
    )


def event_watch_gates(
    df: DataFrame, key: str, date: str, value: str, event: Column, expected: Mapping[str, float], tolerance: float,
    tie: str | None = None,
) -> DataFrame:
    """Gate rows comparing each series' baseline with its pinned figure."""
    summary = baseline_latest_summary(df, key, date, value, event, tie)
    one = summary.agg(
        *[F.max(F.when(F.col(key) == F.lit(k), F.col("baseline_value"))).alias(f"__{i}") for i, k in enumerate(expected)]
    )
    gates = [
        Gate(f"baseline_{k}", F.col(f"__{i}"), "absolute", v, tolerance) for i, (k, v) in enumerate(expected.items())
    ]
    return gate_rows(one, gates)


def member_ranking(df: DataFrame, filters: Mapping[str, object], area: str, members: Sequence[str], v: str) -> DataFrame:
    """Members of a set in order of their value."""
    kept = filter_codes(df, filters).filter(F.col(area).isin(*members))
    return kept.select(area, v).orderBy(F.col(v).desc(), area)


def latest_growth(
    df: DataFrame, filters: Mapping[str, object], area: str, period: str, v: str, k: int, tie: str,
    min_period: str | None = None, digits: int = 2,
) -> DataFrame:
    """The newest growth rate of each area, the ``k`` highest shown lowest first."""
    newest = latest_per_group(filter_codes(df, filters), [area], period, tie, min_period)
    rounded = newest.select(area, F.col(period).alias("period"), F.bround(v, digits).alias("growth"))
    return top_k(rounded, "growth", k, area)


def top_economies(df: DataFrame, code: str, pattern: str, aggregates: Sequence[str], v: str, k: int) -> DataFrame:
    """Largest values after dropping malformed codes and aggregates."""
    kept = filter_regex(df, code, pattern).filter(~F.col(code).isin(*aggregates) & F.col(v).isNotNull())
    return top_k(kept.select(code, v), v, k, code, ascending_display=False)


def financing_bands(
    df: DataFrame, filters: Mapping[str, object], scheme: str, schemes: Mapping[str, str], period: str, v: str,
    labels: Sequence[str], last: int,
) -> DataFrame:
    """Sums by year and mapped band, bands in stacking order."""
    kept = filter_codes(df, filters).filter(F.col(scheme).isin(*schemes))
    coded = kept.withColumns({"year": to_number(period).cast("int"), "band": recode(scheme, schemes)})
    sums = E.group_sum(coded.filter(F.col("year") <= last), ["year", "band"], v)
    return sums.orderBy("year", label_rank("band", labels))


def level_versus_peers(
    df: DataFrame, filters: Mapping[str, object], area: str, names: Mapping[str, str], v: str, peers: Sequence[str]
) -> DataFrame:
    """Levels by country beside the unweighted mean of a peer set."""
    levels = filter_codes(df, filters).withColumn("country", recode(area, names)).select("country", F.col(v).alias("level"))
    peer = E.reference_group(levels, "country", peers, "level")
    return with_one_row(levels, peer).orderBy(F.col("level").desc(), "country")


def wage_grid(
    df: DataFrame, filters: Mapping[str, object], area: str, names: Mapping[str, str], grid: str, prefix: str,
    low: int, high: int, v: str,
) -> DataFrame:
    """A rate over a grid of wage levels by country."""
    kept = filter_prefix(filter_codes(df, filters), grid, prefix).filter(F.col(area).isin(*names))
    levels = kept.withColumns({"wage_pct": strip_prefix_int(grid, prefix), "country": recode(area, names)})
    return levels.filter(F.col("wage_pct").between(low, high)).select("wage_pct", "country", F.col(v).alias("rate")).orderBy(
        "wage_pct", "country"
    )


def premium_adjusted_grid(
    df: DataFrame, measure: str, rate: str, base: str, area: str, names: Mapping[str, str], grid: str, prefix: str,
    low: int, high: int, v: str, adjusted: str, series: str, add_num: float, add_den: float,
) -> DataFrame:
    """A wage grid plus one country's curve with premiums added, as a further series."""
    kept = filter_prefix(df, grid, prefix).filter(F.col(area).isin(*names))
    wide = measure_self_join(kept, measure, rate, base, [area, grid], v, "rate", "base")
    levels = wide.withColumn("wage_pct", strip_prefix_int(grid, prefix)).filter(F.col("wage_pct").between(low, high))
    plain = levels.select("wage_pct", recode(area, names).alias("country"), "rate")
    extra = levels.filter(F.col(area) == F.lit(adjusted)).select(
        "wage_pct", F.lit(series).alias("country"), premium_adjusted_rate("rate", "base", add_num, add_den).alias("rate")
    )
    return append_series(plain, extra).orderBy("wage_pct", "country")


def premium_gates(grid: DataFrame, series: str, base: str, peers: Sequence[str], at: int) -> DataFrame:
    """Gate rows at one wage level: the adjusted rate exceeds the plain one and the lowest peer."""
    of = lambda name: F.max(F.when(F.col("country") == F.lit(name), F.col("rate")))
    peer = F.min(F.when(F.col("country").isin(*peers), F.col("rate")))
    one = grid.filter(F.col("wage_pct") == at).agg(of(series).alias("a"), of(base).alias("b"), peer.alias("p"))
    return gate_rows(
        one,
        [
            Gate("adjusted_above_plain", F.col("a") - F.col("b"), "above", 0),
            Gate("adjusted_above_lowest_peer", F.col("a") - F.col("p"), "at_least", 0),
        ],
    )


def price_by_owner(
    df: DataFrame, observed: Column, owner: str, classes: Sequence[str], revenue: str, sales: str, mask: bool = True
) -> DataFrame:
    """Cents per kilowatt-hour by owner class and for all owners, in one pass."""
    price = E.ratio_of_totals(revenue, sales, 100.0, mask)
    totals = df.filter(observed).rollup(owner).agg(F.grouping(owner).alias("__all"), price.alias("price"))
    named = totals.select(F.when(F.col("__all") == 1, F.lit("all owners")).otherwise(F.col(owner)).alias("owner"), "price")
    return named.filter(F.col("owner").isin(*classes, "all owners")).orderBy("price", "owner")


def price_by_class(df: DataFrame, observed: Column, classes: Mapping[str, Column], revenue: str, sales: str) -> DataFrame:
    """Cents per kilowatt-hour of each class and of all rows, in one pass.

    A class is a condition over any columns, such as an owner or a balancing authority, so classes may
    overlap. A class without sales has a null price, which comes last.
    """
    conditions = {**classes, "all owners": F.lit(True)}
    prices = [
        F.struct(F.lit(name).alias("owner"), E.ratio_of_totals(F.when(where, F.col(revenue)), F.when(where, F.col(sales)), 100.0).alias("price"))
        for name, where in conditions.items()
    ]
    one = df.filter(observed).agg(F.array(*prices).alias("prices"))
    return one.select(F.explode("prices").alias("p")).select("p.owner", "p.price").orderBy(F.col("price").asc_nulls_last(), "owner")


def price_gates(prices: DataFrame, a: str, b: str, official: float, low: float, high: float) -> DataFrame:
    """Gate row for the overall price against the published one, with the a-to-b ratio noted."""
    of = lambda name: F.max(F.when(F.col("owner") == F.lit(name), F.col("price")))
    one = prices.agg(of("all owners").alias("u"), of(a).alias("a"), of(b).alias("b"))
    return gate_rows(
        one,
        [
            Gate("benchmark_price", ratio("u", F.lit(official)), "band", low, high),
            Gate("owner_ratio", ratio("a", "b"), "above", 0),
        ],
    )


# --- agreement across sources --------------------------------------------------------------------

AGREEMENT_COLUMNS = ("check", "value_a", "value_b", "difference", "status", "note")


def _agreement(pair: DataFrame, check: str, difference: Column, tolerance: float, informational: bool = False) -> DataFrame:
    absent = F.col("value_a").isNull() | F.col("value_b").isNull()
    passed = F.lit(PASS) if informational else F.when(difference <= F.lit(tolerance), F.lit(PASS)).otherwise(F.lit(FAIL))
    return pair.select(
        F.lit(check).alias("check"),
        "value_a",
        "value_b",
        difference.alias("difference"),
        F.when(absent, F.lit(FAIL)).otherwise(passed).alias("status"),
        F.when(absent, F.lit("missing value")).otherwise(F.lit("informational" if informational else "")).alias("note"),
    )


def _skipped(df: DataFrame, check: str, note: str) -> DataFrame:
    none = F.lit(None).cast("double")
    return df.sparkSession.range(1).select(
        F.lit(check).alias("check"), none.alias("value_a"), none.alias("value_b"), none.alias("difference"),
        F.lit(SKIP).alias("status"), F.lit(note).alias("note"),
    )


def population_agreement(
    a: DataFrame, b: DataFrame, weights_a: Sequence[str], weights_b: Sequence[str], tolerance: float = 0.05,
    check: str = "population",
) -> DataFrame:
    """Weighted totals of two surveys within a relative tolerance; skipped without weights."""
    wa, wb = first_present(a, weights_a), first_present(b, weights_b)
    if wa is None or wb is None:
        return _skipped(a, check, "weight column absent")
    pair = cross_source_pair(a.agg(F.sum(to_number(wa)).alias("value_a")), b.agg(F.sum(to_number(wb)).alias("value_b")))
    return _agreement(pair, check, relative_difference("value_a", "value_b"), tolerance)


def share_agreement(
    a: DataFrame, b: DataFrame, code_a: Sequence[str], code_b: Sequence[str], weights_a: Sequence[str],
    weights_b: Sequence[str], code: str, tolerance_points: float = 5.0, check: str = "share",
) -> DataFrame:
    """Weighted share of one code in two surveys within percentage points. Codes may be bare
    numbers or start a label, as in ``3 UNINSURED``."""
    found = [first_present(a, code_a), first_present(a, weights_a), first_present(b, code_b), first_present(b, weights_b)]
    if any(c is None for c in found):
        return _skipped(a, check, "column absent")

    def share(df: DataFrame, c: str, w: str, out: str) -> DataFrame:
        text = F.trim(F.col(c).cast("string"))
        hit = F.coalesce(text.rlike(rf"^{code}(\D|$)"), F.lit(False))
        weight = F.coalesce(to_number(w), F.lit(0.0))
        return df.agg(E.weighted_share(hit, weight).alias(out))

    pair = cross_source_pair(share(a, found[0], found[1], "value_a"), share(b, found[2], found[3], "value_b"))
    gap = F.abs(F.col("value_a") - F.col("value_b")) * F.lit(100.0)
    return _agreement(pair, check, gap, tolerance_points)


def macro_agreement(
    a: DataFrame, b: DataFrame, filters_a: Mapping[str, object], filters_b: Mapping[str, object], period_a: str,
    v_a: str, v_b: str, unit: float, rate: float, check: str = "macro",
) -> DataFrame:
    """The newest value of one source beside another's after unit and currency conversion."""
    newest = filter_codes(a, filters_a).agg(F.max_by(v_a, period_a).alias("value_a"))
    other = filter_codes(b, filters_b).agg((F.max(v_b) * F.lit(unit) * F.lit(rate)).alias("value_b"))
    pair = cross_source_pair(newest, other)
    return _agreement(pair, check, relative_difference("value_a", "value_b"), 0.0, informational=True)
