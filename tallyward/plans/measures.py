"""Report measures as expressions over one aggregation.

A measure is a base aggregate (sum, count, distinct count, min, max with a row
condition) or a formula over other measures. ``measure`` expands the formulas, computes
every base aggregate they need in one grouped pass and applies the formulas to the
grouped rows. Rules: a quotient by zero or null is null; in a difference one missing side counts
as 0; a count of no rows is null unless stated; distinct counts are recomputed per grouping.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.numbers import ratio
from tallyward.operators.joins import null_safe
from tallyward.plans import rules


@dataclass(frozen=True)
class Base:
    """An aggregate of the fact. ``how`` is sum, count, distinct, min or max."""

    how: str
    column: str = ""
    when: str = ""
    zero: bool = False


@dataclass(frozen=True)
class Formula:
    """``kind`` of ratio, minus, prior, at_year, any_year, share, unfiltered, same, interval, date_text."""

    kind: str
    of: tuple[str, ...]
    scale: float = 1.0
    offset: float = 0.0
    year: int = 0


def _yoy(cur: str, prior: str) -> tuple[Formula, Formula]:
    return Formula("minus", (cur, prior)), Formula("ratio", (f"{cur}_change", prior))


def registry(base_year: int = 2020, main_source: str = "faers", scheduler: str = "github_actions"
             ) -> dict[str, Base | Formula]:
    """All measures by name."""
    led = "is_owner_led"
    active = f"{led} AND status_group = 'Active'"
    phase3 = "phase_group IN ('Phase 3', 'Phase 2/3')"
    case = "primaryid"
    clean = "NOT overlapped_previous_run"
    out: dict[str, Base | Formula] = {
        # Spending
        "spend_usd": Base("sum", "spending_usd"),
        "spend_chf": Base("sum", "spending_chf"),
        "medicare_claims": Base("sum", "claims"),
        "spend_usd_m": Formula("same", ("spend_usd",), scale=1e-6),
        "spend_growth_brands": Base("sum", "spending_usd", f"portfolio_segment = '{rules.SEGMENT_GROWTH}'"),
        "spend_loe": Base("sum", "spending_usd", f"portfolio_segment = '{rules.SEGMENT_LOE}'"),
        "growth_brands_share": Formula("ratio", ("spend_growth_brands", "spend_usd")),
        "growth_brands_share_py": Formula("prior", ("growth_brands_share",)),
        "growth_brands_share_change": Formula(
            "minus", ("growth_brands_share", "growth_brands_share_py"), scale=100),
        "spend_loe_base": Formula("at_year", ("spend_loe",), year=base_year),
        "loe_erosion": Formula("ratio", ("spend_loe", "spend_loe_base"), offset=-1),
        "spend_base": Formula("at_year", ("spend_usd",), year=base_year),
        "spend_index": Formula("ratio", ("spend_usd", "spend_base"), scale=100),
        "spend_share": Formula("share", ("spend_usd",)),
        # Trials
        "trials": Base("count"),
        "home_trials": Formula("unfiltered", ("trials",)),
        "owner_led_trials": Base("count", when=led),
        "active_trials": Base("count", when=active),
        "recruiting_trials": Base("count", when=f"{led} AND overall_status = 'RECRUITING'"),
        "completed_trials": Base("count", when=f"{led} AND status_group = 'Completed'"),
        "stopped_trials": Base("count", when=f"{led} AND status_group = 'Stopped'"),
        "closed_trials": Base("count", when=f"{led} AND status_group IN ('Stopped', 'Completed')"),
        "stopped_early_rate": Formula("ratio", ("stopped_trials", "closed_trials")),
        "active_phase3_trials": Base("count", when=f"{active} AND {phase3}"),
        "phase3_share_of_active": Formula("ratio", ("active_phase3_trials", "active_trials")),
        "readouts_next_12m": Base("count", when=f"{led} AND readout_next_12_months"),
        "readouts_next_12m_phase3": Base("count", when=f"{led} AND readout_next_12_months AND {phase3}"),
        "patients_in_active_trials": Base("sum", "enrollment_count", active),
        "avg_enrollment_active": Formula("ratio", ("patients_in_active_trials", "active_trials")),
        # Safety
        "safety_cases": Base("distinct", case),
        "home_safety_cases": Formula("unfiltered", ("safety_cases",)),
        "serious_cases": Base("distinct", case, "is_serious"),
        "any_serious_outcome": Formula("same", ("serious_cases",)),
        "non_serious_cases": Formula("minus", ("safety_cases", "serious_cases")),
        "fatal_cases": Base("distinct", case, "is_death"),
        "life_threatening_cases": Base("distinct", case, "is_life_threatening"),
        "hospitalisation_cases": Base("distinct", case, "is_hospitalisation"),
        "hcp_reported_cases": Base("distinct", case, "is_health_professional_report"),
        "serious_share": Formula("ratio", ("serious_cases", "safety_cases")),
        "fatal_share": Formula("ratio", ("fatal_cases", "safety_cases")),
        "hcp_reported_share": Formula("ratio", ("hcp_reported_cases", "safety_cases")),
        "signals_evaluated": Base("count"),
        "active_signals": Base("count", when="is_reportable_signal"),
        "product_recalls": Base("count", zero=True),
        "class_1_recalls": Base("count", when="classification = 'Class I'", zero=True),
        "prr_lower_min": Base("min", "prr_lower_95"),
        "prr_upper_max": Base("max", "prr_upper_95"),
        "first_signal_key": Base("min", "signal_key"),
        "last_signal_key": Base("max", "signal_key"),
        "prr_interval": Formula("interval", (
            "first_signal_key", "last_signal_key", "prr_lower_min", "prr_upper_max")),
        # Runs, tests, volumes, stream
        "ingestion_runs": Base("count"),
        "successful_runs": Base("count", when="status = 'success'"),
        "run_success_rate": Formula("ratio", ("successful_runs", "ingestion_runs")),
        "overlapping_runs": Base("count", when="overlapped_previous_run"),
        "scheduled_runs": Base("count", when=f"triggered_by = '{scheduler}'"),
        "rows_ingested": Base("sum", "rows_loaded", clean),
        "main_source_rows": Base("sum", "rows_loaded", f"source = '{main_source}' AND {clean}"),
        "main_source_records": Formula("any_year", ("main_source_rows",)),
        "last_finished_at": Base("max", "finished_at"),
        "data_as_of": Formula("date_text", ("last_finished_at",)),
        "invocations": Base("distinct", "invocation_id"),
        "tests_run": Base("count", when="resource_type = 'test'"),
        "tests_passed": Base("count", when="resource_type = 'test' AND status = 'pass'"),
        "test_pass_rate": Formula("ratio", ("tests_passed", "tests_run")),
        "cost_estimate": Base("sum", "estimated_cost_usd"),
        "bytes_total": Base("sum", "bytes_processed"),
        "gb_processed": Formula("same", ("bytes_total",), scale=1e-9),
        "layer_rows": Base("sum", "row_count"),
        "layer_size_mb": Base("sum", "size_mb"),
        "stream_messages": Base("sum", "messages"),
        "stream_valid": Base("sum", "valid"),
        "stream_invalid": Base("sum", "invalid"),
        "stream_invalid_rate": Formula("ratio", ("stream_invalid", "stream_messages")),
        "stream_max_lag": Base("max", "consumer_lag"),
        "throughput_sum": Base("sum", "throughput_msg_per_sec"),
        "throughput_batches": Base("count", when="throughput_msg_per_sec IS NOT NULL"),
        "stream_avg_throughput": Formula("ratio", ("throughput_sum", "throughput_batches")),
        "stream_events": Base("count"),
    }
    for name in ("spend_usd", "spend_chf", "medicare_claims", "safety_cases"):
        prior = f"{name}_py"
        out[prior] = Formula("prior", (name,))
        out[f"{name}_change"], out[f"{name}_yoy"] = _yoy(name, prior)
    return out


CURRENT, PRIOR, ANY = "cur", "py", "any"


class _Expansion:
    """Formulas as columns over leaf columns ``<measure>@<role>``, and the leaves they need."""

    def __init__(self, measures: Mapping[str, Base | Formula]):
        self.measures = measures
        self.leaves: set[tuple[str, str]] = set()
        self.totals: set[str] = set()
        self.unfiltered: set[str] = set()

    def leaf(self, name: str, role: str) -> Column:
        self.leaves.add((name, role))
        return F.col(f"`{name}@{role}`")

    def column(self, name: str, role: str = CURRENT) -> Column:
        spec = self.measures[name]
        if isinstance(spec, Base):
            return self.leaf(name, role)
        kind, of = spec.kind, spec.of
        if kind == "prior":
            return self.column(of[0], PRIOR)
        if kind == "at_year":
            return self.column(of[0], str(spec.year))
        if kind == "any_year":
            return self.column(of[0], ANY)
        if kind == "share":
            self.totals.add(of[0])
            return ratio(self.column(of[0], role), F.col(f"`{of[0]}@total`"))
        if kind in ("unfiltered", "date_text"):
            self.unfiltered.add(of[0])
            value = F.col(f"`{of[0]}@unfiltered`")
            return F.date_format(value, "dd MMM yyyy") if kind == "date_text" else value
        parts = [self.column(p, role) for p in of]
        if kind == "interval":
            first, last, low, high = parts
            text = F.concat(F.format_string("%.2f", low), F.lit(" to "), F.format_string("%.2f", high))
            return F.when(first == last, text)
        if kind == "ratio":
            value = ratio(*parts)
        elif kind == "minus":
            a, b = parts
            value = F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))
        else:
            value = parts[0]
        if spec.scale != 1.0:
            value = value.cast("double") * F.lit(spec.scale) if spec.scale >= 1 else \
                value.cast("double") / F.lit(1 / spec.scale)
        return value + F.lit(spec.offset) if spec.offset else value


def _aggregate(df: DataFrame, by: Sequence[str], leaves: Mapping[str, tuple[Base, Column]]) -> DataFrame:
    """One grouped pass for all leaves; distinct counts first collapse to one row per id."""
    ids = {spec.column for spec, _ in leaves.values() if spec.how == "distinct"}
    if len(ids) > 1:
        raise ValueError("one distinct column at a time")

    def first(spec: Base, cond: Column) -> Column:
        if spec.how == "count":
            return F.count_if(cond)
        if spec.how == "distinct":
            return F.bool_or(cond & F.col(spec.column).isNotNull())
        return getattr(F, spec.how)(F.when(cond, F.col(spec.column)))

    def second(spec: Base, name: str) -> Column:
        c = F.col(f"`{name}`")
        if spec.how == "distinct":
            return F.count_if(c)
        return F.sum(c) if spec.how in ("sum", "count") else getattr(F, spec.how)(c)

    grouped = df.groupBy(*by, *ids).agg(*[first(s, c).alias(n) for n, (s, c) in leaves.items()])
    if ids:
        grouped = grouped.groupBy(*by).agg(*[second(s, n).alias(n) for n, (s, _) in leaves.items()])
    counts = {n: F.nullif(F.col(f"`{n}`"), F.lit(0)) for n, (s, _) in leaves.items()
              if s.how in ("count", "distinct") and not s.zero}
    return grouped.withColumns(counts) if counts else grouped


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on columns of equal names, null-safe; the keys of either side survive."""
    other = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    both = left.join(other, null_safe(keys, [f"__{k}" for k in keys]), how)
    return both.withColumns({k: F.coalesce(k, f"__{k}") for k in keys}).drop(*[f"__{k}" for k in keys])


def _sideways(cells: DataFrame, others: Sequence[str], year: str, leaves: set[tuple[str, str]]) -> DataFrame:
    """Values of other years beside each group and year.

    A group that has the year before but not this one has a row for it, unless no group
    has the year at all: its current value is missing, its change is minus 100 %.
    """
    column = {n: F.col(f"`{n}@{CURRENT}`") for n, _ in leaves}
    out = cells
    before = sorted(n for n, role in leaves if role == PRIOR)
    if before:
        kind = cells.schema[year].dataType
        prior = cells.select(*others, (F.col(year) + 1).cast(kind).alias(year),
                             *[column[n].alias(f"{n}@{PRIOR}") for n in before])
        years = cells.select(F.col(year).alias("__known")).distinct()
        prior = prior.join(years, F.col(year) == F.col("__known"), "left_semi")
        out = _joined(out, prior, [*others, year], "full_outer")
    across = {f"{n}@{role}": F.sum(column[n]) if role == ANY else F.max(F.when(F.col(year) == int(role), column[n]))
              for n, role in sorted(leaves) if role not in (CURRENT, PRIOR)}
    if across:
        spread = cells.groupBy(*others).agg(*[c.alias(n) for n, c in across.items()])
        out = _joined(out, spread, others, "left") if others else out.withColumns(
            {n: spread.select(f"`{n}`").scalar() for n in across})
    return out


def measure(names: Sequence[str], df: DataFrame, by: Sequence[str] = (), where: Column | None = None,
            member_where: Column | None = None, years: Sequence[int] | None = None, year: str = "year",
            measures: Mapping[str, Base | Formula] | None = None) -> DataFrame:
    """``names`` per ``by`` over a fact with its dimension columns.

    ``where`` filters the fact; ``member_where`` holds the filters on products and areas,
    which a share of total ignores in its denominator; ``years`` is the selection on the
    year, which prior-year and base-year measures shift or drop.
    """
    plan = _Expansion(measures or registry())
    outputs = [plan.column(n).alias(n) for n in names]
    filters = [c for c in (where, member_where) if c is not None]
    rows = df.where(reduce(lambda a, b: a & b, filters)) if filters else df
    condition = {n: F.expr(plan.measures[n].when) if plan.measures[n].when else F.lit(True)
                 for n in {n for n, _ in plan.leaves} | plan.totals | plan.unfiltered}

    def in_years(shift: int = 0) -> Column:
        return F.lit(True) if years is None else (F.col(year) + shift).isin(list(years))

    def spec(name: str, cond: Column) -> tuple[Base, Column]:
        return plan.measures[name], F.coalesce(condition[name] & cond, F.lit(False))

    if year in by:
        # Group once per year over all years, then look sideways within each group.
        others = [c for c in by if c != year]
        names_needed = sorted({n for n, _ in plan.leaves})
        out = _aggregate(rows, by, {f"{n}@{CURRENT}": spec(n, F.lit(True)) for n in names_needed})
        out = _sideways(out, others, year, plan.leaves).where(in_years())
    else:
        def role_condition(role: str) -> Column:
            if role == CURRENT:
                return in_years()
            if role == PRIOR:
                if years is None:
                    raise ValueError("a prior-year measure needs years or a grouping by year")
                return in_years(1)
            return F.lit(True) if role == ANY else F.col(year) == int(role)

        out = _aggregate(rows, by, {f"{n}@{r}": spec(n, role_condition(r)) for n, r in sorted(plan.leaves)})

    if plan.totals:
        over = [c for c in by if c in _KEPT_BY_SHARE or c == year]
        base = df.where(where) if where is not None else df
        total = _aggregate(base, over, {f"{n}@total": spec(n, in_years()) for n in sorted(plan.totals)})
        if over:
            total = total.select(*[F.col(c).alias(f"__{c}") for c in over],
                                 *[F.col(f"`{n}@total`") for n in sorted(plan.totals)])
            out = out.join(total, null_safe(over, [f"__{c}" for c in over]), "left")
        else:
            out = out.withColumns({f"{n}@total": total.select(f"`{n}@total`").scalar() for n in plan.totals})
    for n in sorted(plan.unfiltered):
        alone = _aggregate(df, [], {f"{n}@unfiltered": (plan.measures[n], F.coalesce(condition[n], F.lit(False)))})
        out = out.withColumn(f"{n}@unfiltered", alone.scalar())
    return out.select(*by, *outputs)


# Grouping columns a share of total keeps in its denominator (all but products and areas).
_KEPT_BY_SHARE = {"program", "year_date"}
