"""Contract gates. Every gate is a row ``(gate, status, observed, expected, tolerance, note)``.

A ``Gate`` holds an aggregate; all gates of one table run in a single aggregation, optionally
per release. Status is ``pass``, ``fail`` or ``skip``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.frames import weight_columns
from ..functions.numeric import to_number, valid_weight
from .joins import fk_orphans, key_set_match, one_to_one, value_match_join
from .uncertainty import REPLICATE, W, to_replicates

PASS, FAIL, SKIP = "pass", "fail", "skip"
GATE_COLUMNS = ("gate", "status", "observed", "expected", "tolerance", "note")
GATE_SCHEMA = "gate string, status string, observed double, expected double, tolerance double, note string"


@dataclass(frozen=True)
class Gate:
    """``observed`` is an aggregate (or, in ``gate_rows``, any column of a one-row frame)."""

    name: str
    observed: Column
    rule: str = "equal"
    expected: float | None = None
    tolerance: float | None = None
    note: str = ""
    skip: Column | None = None


def _verdict(gate: Gate, observed: Column) -> Column:
    want = F.lit(gate.expected).cast("double")
    slack = F.lit(0.0 if gate.tolerance is None else gate.tolerance).cast("double")
    rules = {
        "equal": lambda: observed == want,
        "absolute": lambda: F.abs(observed - want) <= slack,
        "relative": lambda: F.try_divide(F.abs(observed - want), F.abs(want)) <= slack,
        "at_least": lambda: observed >= want,
        "at_most": lambda: observed <= want,
        "above": lambda: observed > want,
        # The band is expected .. tolerance.
        "band": lambda: observed.between(want, slack),
    }
    return F.coalesce(rules[gate.rule](), F.lit(False))


def gate_rows(one_row: DataFrame, gates: Sequence[Gate], by: Sequence[str] = ()) -> DataFrame:
    """Turn aggregated columns into gate rows."""
    structs = []
    for gate in gates:
        observed = gate.observed.cast("double")
        status = F.when(_verdict(gate, observed), F.lit(PASS)).otherwise(F.lit(FAIL))
        if gate.skip is not None:
            status = F.when(gate.skip, F.lit(SKIP)).otherwise(status)
        structs.append(
            F.struct(
                F.lit(gate.name).alias("gate"),
                status.alias("status"),
                observed.alias("observed"),
                F.lit(gate.expected).cast("double").alias("expected"),
                F.lit(gate.tolerance).cast("double").alias("tolerance"),
                F.lit(gate.note).alias("note"),
            )
        )
    return one_row.select(*by, F.inline(F.array(*structs)))


def run_gates(df: DataFrame, gates: Sequence[Gate], by: Sequence[str] = ()) -> DataFrame:
    """All gates of a table in one aggregation, one set of rows per ``by`` group."""
    named = {f"__g{i}": g for i, g in enumerate(gates)}
    aggregates = [g.observed.cast("double").alias(n) for n, g in named.items()]
    skips = [g.skip.alias(f"{n}_skip") for n, g in named.items() if g.skip is not None]
    table = df.groupBy(*by).agg(*aggregates, *skips)
    resolved = [
        Gate(g.name, F.col(n), g.rule, g.expected, g.tolerance, g.note, None if g.skip is None else F.col(f"{n}_skip"))
        for n, g in named.items()
    ]
    return gate_rows(table, resolved, by)


# --- gates known from the plan alone; no job runs -------------------------------------------


def plan_gates(spark: SparkSession, results: Iterable[tuple[str, float, float, bool, str]]) -> DataFrame:
    rows = [(n, PASS if ok else FAIL, float(obs), float(exp), None, note) for n, obs, exp, ok, note in results]
    return spark.createDataFrame(rows, GATE_SCHEMA)


def required_columns(df: DataFrame, required: Sequence[str]) -> tuple[str, float, float, bool, str]:
    missing = sorted(set(required) - set(df.columns))
    return "required_columns", len(missing), 0, not missing, ",".join(missing)


def forbidden_columns(df: DataFrame, forbidden: Sequence[str]) -> tuple[str, float, float, bool, str]:
    present = sorted(set(forbidden) & set(df.columns))
    return "forbidden_columns", len(present), 0, not present, ",".join(present)


def column_count(df: DataFrame, expected: int) -> tuple[str, float, float, bool, str]:
    return "column_count", len(df.columns), expected, len(df.columns) == expected, ""


def ordered_header(
    df: DataFrame, expected: Sequence[str], fold_case: bool = False
) -> tuple[str, float, float, bool, str]:
    have, want = list(df.columns), list(expected)
    if fold_case:
        have, want = [c.lower() for c in have], [c.lower() for c in want]
    same = sum(a == b for a, b in zip(have, want))
    return "ordered_header", same, len(want), have == want, ""


def replicate_columns(
    df: DataFrame, prefix: str, count: int, start: int = 1
) -> tuple[str, float, float, bool, str]:
    """Replicate columns are complete and numbered without gaps."""
    try:
        found = len(weight_columns(df, prefix, count, start))
        return "replicate_columns", found, count, True, ""
    except ValueError as error:
        found = sum(bool(re.fullmatch(re.escape(prefix) + r"\d+", c)) for c in df.columns)
        return "replicate_columns", found, count, False, str(error)


# --- fused table gates -----------------------------------------------------------------------


def row_count(expected: int) -> Gate:
    return Gate("row_count", F.count(F.lit(1)), "equal", expected)


def row_minimum(minimum: int) -> Gate:
    return Gate("row_minimum", F.count(F.lit(1)), "at_least", minimum)


def non_empty() -> Gate:
    return Gate("non_empty", F.count(F.lit(1)), "above", 0)


def key_non_null(keys: Sequence[str]) -> Gate:
    bad = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return Gate("key_non_null", F.count_if(bad), "equal", 0, note=",".join(keys))


def weights_valid(w: str, allow_zero: bool = False) -> list[Gate]:
    """Finiteness and sign of one weight column, and that its total is positive."""
    value = F.col(w).cast("double")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    sign = (value >= 0) if allow_zero else (value > 0)
    return [
        Gate(f"{w}_finite", F.count_if(~finite), "equal", 0),
        Gate(f"{w}_sign", F.count_if(finite & ~sign), "equal", 0, note="zero allowed" if allow_zero else "positive"),
        Gate(f"{w}_total", F.sum(F.when(finite, value)), "above", 0),
    ]


def domain(column: str, allowed: Sequence, name: str | None = None) -> Gate:
    """Values outside the allowed set; null is not a value."""
    return Gate(name or f"{column}_domain", F.count_if(~F.col(column).isin(*allowed)), "equal", 0)


def domain_complete(column: str, expected: Sequence, name: str | None = None) -> Gate:
    """How many expected values occur: one flag per value, never a collected set."""
    seen = [F.coalesce(F.max(F.when(F.col(column) == F.lit(v), F.lit(1))), F.lit(0)) for v in expected]
    return Gate(name or f"{column}_complete", reduce(lambda a, b: a + b, seen), "equal", len(expected))


def benchmark(
    name: str, observed: Column, expected: float, tolerance: float, relative: bool = False, note: str = ""
) -> Gate:
    return Gate(name, observed, "relative" if relative else "absolute", expected, tolerance, note)


def benchmark_band(name: str, observed: Column, low: float, high: float, note: str = "") -> Gate:
    return Gate(name, observed, "band", low, high, note)


def benchmark_order(name: str, larger: Column, smaller: Column, strict: bool = False) -> Gate:
    return Gate(name, larger - smaller, "above" if strict else "at_least", 0)


def benchmark_presence(name: str, predicate: Column) -> Gate:
    return Gate(name, F.count_if(predicate), "above", 0, note="presence only")


def year_benchmark(name: str, observed: Column, expected: float, tolerance: float, year: str, pinned: int) -> Gate:
    """A benchmark that holds for its pinned year; other years are checked for structure only."""
    return Gate(
        name, observed, "relative", expected, tolerance, f"pinned {pinned}", skip=F.max(year) != F.lit(pinned)
    )


def period_in_range(period: str, low, high) -> list[Gate]:
    """At least one period lies in the range, and how many rows lie outside."""
    inside = F.col(period).between(low, high)
    return [
        Gate("period_in_range", F.count_if(inside), "above", 0),
        Gate("period_outside", F.count_if(~inside), "at_least", 0, note="informational"),
    ]


def period_equals(period: str, release: int) -> Gate:
    """Every row carries the release's period."""
    return Gate("period_equals", F.count_if(~F.col(period).eqNullSafe(F.lit(release))), "equal", 0)


def series_quality(value: str, date: str, minimum: int) -> list[Gate]:
    """Enough readable values, and no unreadable date."""
    return [
        Gate("observations", F.count(to_number(value)), "at_least", minimum),
        Gate("dates", F.count_if(F.col(date).cast("string").try_cast("date").isNull()), "equal", 0),
    ]


def numeric_columns(columns: Sequence[str], pairs: Sequence[tuple[str, str]] = ()) -> list[Gate]:
    """Every row of each column reads as a number; bounds come in pairs, in order."""
    gates = [Gate(f"{c}_numeric", F.count_if(to_number(c).isNull()), "equal", 0) for c in columns]
    for low, high in pairs:
        lo, hi = to_number(low), to_number(high)
        broken = (lo.isNull() != hi.isNull()) | F.coalesce(lo > hi, F.lit(False))
        gates.append(Gate(f"{low}_{high}_pair", F.count_if(broken), "equal", 0))
    return gates


def arithmetic(name: str, left: Column, right: Column, tolerance: float = 0.0) -> Gate:
    """Rows in which a published figure does not follow from the others."""
    off = F.coalesce(F.abs(left - right) > F.lit(tolerance), F.lit(True))
    return Gate(name, F.count_if(off), "equal", 0, note="published arithmetic")


def triple_exists(name: str, code: tuple[str, str], source: tuple[str, str], label: tuple[str, str]) -> Gate:
    """A mapping table holds the code with its source, under a description with the label."""
    hit = (
        (F.trim(F.col(code[0]).cast("string")) == F.lit(code[1]))
        & (F.trim(F.col(source[0]).cast("string")) == F.lit(source[1]))
        & F.lower(F.col(label[0])).contains(label[1].lower())
    )
    return Gate(name, F.count_if(hit), "above", 0)


# Kinds of a record contract and the variant types that satisfy them.
RECORD_KINDS = {
    "string": "^STRING",
    "number": "^(BIGINT|DECIMAL|DOUBLE|FLOAT)",
    "boolean": "^BOOLEAN",
    "object": "^OBJECT",
    "array": "^ARRAY",
}


def record_contract(text: str, kinds: Mapping[str, str], id_key: str, id_pattern: str) -> list[Gate]:
    """Required keys of a JSON record with the right kind, and an identifier pattern."""
    record = F.try_parse_json(F.col(text))
    gates = [Gate("record_parses", F.count_if(record.isNull()), "equal", 0)]
    for key, kind in kinds.items():
        found = F.schema_of_variant(F.try_variant_get(record, f"$.{key}", "variant"))
        ok = F.coalesce(found.rlike(RECORD_KINDS[kind]), F.lit(False))
        gates.append(Gate(f"record_{key}_{kind}", F.count_if(~ok), "equal", 0))
    identifier = F.try_variant_get(record, f"$.{id_key}", "string")
    bad = ~F.coalesce(identifier.rlike(id_pattern), F.lit(False))
    gates.append(Gate(f"record_{id_key}_pattern", F.count_if(bad), "equal", 0))
    return gates


def payload_status(text: str, success: str = "REQUEST_SUCCEEDED") -> list[Gate]:
    """Stored payloads that report failure or carry an error field."""
    status = F.get_json_object(text, "$.status")
    error = F.get_json_object(text, "$.error_code")
    return [
        Gate("payload_status", F.count_if(status.isNotNull() & (status != F.lit(success))), "equal", 0),
        Gate("payload_error", F.count_if(error.isNotNull()), "equal", 0),
    ]


def payloads_parse(text: str) -> list[Gate]:
    """Payloads that are absent or no JSON document. The flatteners return no rows for them, so the
    stored payloads are gated before they are flattened."""
    return [Gate("payloads_parse", F.count_if(F.try_parse_json(F.col(text)).isNull()), "equal", 0)]


def provenance_recorded(columns: Sequence[str]) -> list[Gate]:
    return [Gate(f"provenance_{c}", F.count_if(F.col(c).isNull()), "equal", 0) for c in columns]


# --- gates that need a join or a regrouping --------------------------------------------------


def key_unique_gate(
    df: DataFrame, keys: Sequence[str], name: str = "key_unique", by: Sequence[str] = ()
) -> DataFrame:
    """Keys with more than one row, per release if ``by`` is given. Counts combine before the
    shuffle."""
    counts = df.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("__n"))
    repeated = counts.groupBy(*by).agg(F.count_if(F.col("__n") > 1).alias("__bad"))
    return gate_rows(repeated, [Gate(name, F.col("__bad"), "equal", 0, note=",".join(keys))], by)


def foreign_key_gate(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, name: str = "foreign_key") -> DataFrame:
    orphans = fk_orphans(child, parent, child_key, parent_key).agg(F.count(F.lit(1)).alias("__bad"))
    return gate_rows(orphans, [Gate(name, F.col("__bad"), "equal", 0, note=f"{child_key} in {parent_key}")])


def key_sets_gate(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return gate_rows(
        key_set_match(a, b, keys),
        [Gate("keys_only_left", F.col("only_a"), "equal", 0), Gate("keys_only_right", F.col("only_b"), "equal", 0)],
    )


def one_to_one_gate(df: DataFrame, replicates: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return gate_rows(
        one_to_one(df, replicates, key),
        [
            Gate("join_keys_repeated", F.col("repeated_keys"), "equal", 0),
            Gate("join_keys_unmatched", F.col("unmatched_keys"), "equal", 0),
        ],
    )


def replicate_balance_gate(df: DataFrame, weights: Sequence[str] | Column) -> DataFrame:
    """Half-sample replicates: weights positive or missing, and each replicate has both."""
    long = to_replicates(df, weights, [])
    present = F.col(W).isNotNull() & ~F.isnan(W)
    per = long.groupBy(REPLICATE).agg(
        F.count_if(present & (F.col(W) <= 0)).alias("__bad"),
        F.count_if(present).alias("__have"),
        F.count_if(~present).alias("__miss"),
    )
    one = per.agg(
        F.sum("__bad").alias("__bad"),
        F.count_if((F.col("__have") == 0) | (F.col("__miss") == 0)).alias("__flat"),
    )
    return gate_rows(
        one,
        [
            Gate("replicates_positive_or_missing", F.col("__bad"), "equal", 0),
            Gate("replicates_balanced", F.col("__flat"), "equal", 0),
        ],
    )


def replicate_alignment_gate(
    main: DataFrame, replicates: DataFrame, keys: Sequence[str], weight: str, full: str, tolerance: float = 0.0
) -> DataFrame:
    """The full-sample replicate equals the main weight on matched keys, and the sums agree."""
    match = value_match_join(main, replicates, keys, weight, full, tolerance)
    gap = F.abs(F.col("sum_x") - F.col("sum_y"))
    return gate_rows(
        match,
        [
            Gate("replicate_matched", F.col("matched"), "above", 0),
            Gate("replicate_alignment", F.col("mismatched"), "equal", 0, tolerance),
            Gate("replicate_sum", gap, "absolute", 0, max(tolerance, 1e-6)),
        ],
    )


def implicates_gate(df: DataFrame, family: str, implicate: str, m: int) -> DataFrame:
    """Implicates are exactly 1..m, and each family has each of them once."""
    per = df.groupBy(family).agg(
        F.count(F.lit(1)).alias("__n"),
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(implicate).cast("int"))).alias("__bits"),
        F.min(implicate).alias("__lo"),
        F.max(implicate).alias("__hi"),
    )
    whole = F.lit(sum(1 << i for i in range(1, m + 1))).cast("bigint")
    one = per.agg(
        F.count_if(F.col("__n") != m).alias("__rows"),
        F.count_if(F.col("__bits") != whole).alias("__sets"),
        F.min("__lo").alias("__lo"),
        F.max("__hi").alias("__hi"),
    )
    return gate_rows(
        one,
        [
            Gate("implicate_rows_per_family", F.col("__rows"), "equal", 0),
            Gate("implicate_sets", F.col("__sets"), "equal", 0),
            Gate("implicate_lowest", F.col("__lo"), "equal", 1),
            Gate("implicate_highest", F.col("__hi"), "equal", m),
        ],
    )


def statistics_gate(ours: DataFrame, published: DataFrame, variable: str = "variable", tolerance: float = 1e-5) -> DataFrame:
    """Our count and mean equal the provider's table, one row per variable on each side with
    columns ``n`` and ``mean``."""
    a = ours.select(F.col(variable), F.col("n").alias("__n"), F.col("mean").alias("__m"))
    b = published.select(F.col(variable), F.col("n").alias("__pn"), F.col("mean").alias("__pm"))
    one = b.join(a, variable, "left").agg(
        F.count_if(~F.col("__n").eqNullSafe(F.col("__pn"))).alias("__n_off"),
        F.count_if(F.coalesce(F.abs(F.col("__m") - F.col("__pm")) > F.lit(tolerance), F.lit(True))).alias("__m_off"),
    )
    return gate_rows(
        one,
        [
            Gate("statistics_n", F.col("__n_off"), "equal", 0),
            Gate("statistics_mean", F.col("__m_off"), "equal", 0, tolerance),
        ],
    )


def codebook_gate(
    codebook: DataFrame, name: str, required: Sequence[str], minimum: int, option: tuple[str, str] | None = None
) -> DataFrame:
    """Enough distinct variables, the required ones among them, and a required option value."""
    variable = F.trim(F.col(name))
    found = [F.coalesce(F.max(F.when(variable == F.lit(r), F.lit(1))), F.lit(0)) for r in required]
    gates = [
        Gate("codebook_required", reduce(lambda a, b: a + b, found, F.lit(0)), "equal", len(required)),
    ]
    if option is not None:
        gates.append(Gate("codebook_option", F.count_if(F.col(option[0]).cast("string") == F.lit(option[1])), "above", 0))
    size = codebook.select(variable.alias("__v")).distinct().agg(F.count("__v").alias("__n"))
    return gate_rows(size, [Gate("codebook_size", F.col("__n"), "at_least", minimum)]).unionByName(
        run_gates(codebook, gates)
    )


def member_set_gate(files: DataFrame, contract: DataFrame, member: str, excluded: str | None = None) -> DataFrame:
    """Each contracted member occurs exactly once among the files; an overlapping copy, named by
    a text in its path, does not count and must not be contracted."""
    kept = files if excluded is None else files.filter(~F.lower(F.col(member)).contains(excluded.lower()))
    counts = kept.groupBy(member).agg(F.count(F.lit(1)).alias("__n"))
    want = contract.select(member).distinct()
    one = want.join(counts, member, "left").agg(
        F.count_if(F.coalesce(F.col("__n"), F.lit(0)) == 0).alias("__absent"),
        F.count_if(F.col("__n") > 1).alias("__repeated"),
        (F.count_if(F.lower(F.col(member)).contains(excluded.lower())) if excluded else F.sum(F.lit(0))).alias("__overlap"),
    )
    return gate_rows(
        one,
        [
            Gate("members_absent", F.col("__absent"), "equal", 0),
            Gate("members_repeated", F.col("__repeated"), "equal", 0),
            Gate("members_overlap", F.col("__overlap"), "equal", 0),
        ],
    )


# --- merging and reporting -------------------------------------------------------------------


def merge_gates(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def gates_passed(gates: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per group: passed when no gate failed."""
    return gates.groupBy(*by).agg(
        F.bool_and(F.col("status") != FAIL).alias("passed"),
        F.count(F.lit(1)).alias("n_gates"),
        F.count_if(F.col("status") == FAIL).alias("n_failed"),
    )


def gate_summary(gates: DataFrame, survey: str, benchmark_pattern: str = "benchmark") -> DataFrame:
    """Checks, passes and benchmark status per source. Without a benchmark gate: ``none``."""
    is_benchmark = F.col("gate").contains(benchmark_pattern)
    failed, passed = F.col("status") == FAIL, F.col("status") == PASS
    return gates.groupBy(survey).agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(passed).alias("passed"),
        F.count_if(failed).alias("failed"),
        F.when(F.count_if(is_benchmark & failed) > 0, F.lit(FAIL))
        .when(F.count_if(is_benchmark & passed) > 0, F.lit(PASS))
        .otherwise(F.lit("none"))
        .alias("benchmark_status"),
    )


def redistributable(df: DataFrame, ledger: DataFrame, keys: Sequence[str], flag: str = "redistributable") -> DataFrame:
    """Rows of releases that may be published: the guard in front of result sinks."""
    open_releases = ledger.filter(F.coalesce(F.col(flag), F.lit(False))).select(*keys).distinct()
    return df.join(open_releases, list(keys), "left_semi")


def valid_weight_gate(w: str) -> Gate:
    return Gate(f"{w}_valid", F.count_if(~valid_weight(w)), "equal", 0)
