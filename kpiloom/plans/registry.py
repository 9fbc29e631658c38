"""Metric and schema declarations, checked once on the driver."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from typing import Any


class ConfigError(ValueError):
    """A declaration that cannot be run."""


# Per metric type, the fields it must set (True) and the ones it must not set (False).
RULES = {
    "sum": {"source_col": True, "numerator": False},
    "ratio": {"numerator": True, "denominator": True, "scale": True, "source_col": False},
    "per_unit": {"numerator": True, "denominator": True, "source_col": False},
    "count": {"source_col": False, "numerator": False, "denominator": False, "condition_values": False, "complete_values": False},
    "conditional_count": {"source_col": True, "condition_values": True, "numerator": False, "denominator": False, "complete_values": False},
    "completion_pct": {"source_col": True, "complete_values": True, "scale": True, "numerator": False, "denominator": False, "condition_values": False},
}
VALUE_LISTS = ("condition_values", "complete_values")
DESCRIPTIVE = ("id", "label", "type", "unit", "decimals", "description")


@dataclass(frozen=True)
class Metric:
    id: str
    label: str
    type: str
    unit: str
    decimals: int
    description: str
    source_col: str | None = None
    numerator: str | None = None
    denominator: str | None = None
    scale: float | None = None
    condition_values: tuple[str, ...] | None = None
    complete_values: tuple[str, ...] | None = None

    @property
    def summed_columns(self) -> list[str]:
        if self.type == "sum":
            return [self.source_col]
        if self.type in ("ratio", "per_unit"):
            return [self.numerator, self.denominator]
        return []

    @property
    def condition_column(self) -> str | None:
        return self.source_col if self.type in ("conditional_count", "completion_pct") else None

    @property
    def matched_values(self) -> tuple[str, ...]:
        return self.condition_values or self.complete_values or ()


def metric(declared: dict[str, Any]) -> Metric:
    """Build one metric; the error of a wrong one tells everything that is wrong with it."""
    kind = declared.get("type")
    rules = dict.fromkeys(DESCRIPTIVE, True) | RULES.get(kind, {})
    faults = [f"{'lacks' if must else 'must not set'} {name}" for name, must in rules.items() if (name in declared) != must]
    if "type" in declared and kind not in RULES:
        faults.append(f"has the type {kind!r}, which is none of {sorted(RULES)}")
    given = {name: declared[name] for name in VALUE_LISTS if name in declared}
    faults += [f"needs a list of values as {name}" for name, value in given.items() if not (value and isinstance(value, (list, tuple)))]
    if faults:
        raise ConfigError(f"metric {declared.get('id', '?')!r} " + "; ".join(faults))
    own = {f.name: declared[f.name] for f in fields(Metric) if f.name in declared}
    return Metric(**own | {name: tuple(value) for name, value in given.items()})


@dataclass(frozen=True)
class Registry:
    metrics: tuple[Metric, ...]
    rollups: tuple[tuple[str, ...], ...]

    def __post_init__(self):
        ids = [m.id for m in self.metrics]
        if not ids:
            raise ConfigError("at least one metric must be declared")
        twice = sorted({i for i in ids if ids.count(i) > 1})
        if twice:
            raise ConfigError(f"metric ids declared twice: {twice}")

    @property
    def ids(self) -> list[str]:
        return [m.id for m in self.metrics]

    @property
    def summed_columns(self) -> list[str]:
        return sorted({c for m in self.metrics for c in m.summed_columns})

    @property
    def condition_columns(self) -> list[str]:
        return sorted({m.condition_column for m in self.metrics if m.condition_column})

    @property
    def denominators(self) -> list[str]:
        return sorted({m.denominator for m in self.metrics if m.denominator})

    @property
    def segments(self) -> list[str]:
        return sorted({s for rollup in self.rollups for s in rollup})

    def usable_rollups(self, columns: list[str]) -> list[tuple[str, ...]]:
        """Rollups whose every segment is present; the rest are skipped."""
        return [r for r in self.rollups if set(r) <= set(columns)]


def registry(declared: dict[str, Any]) -> Registry:
    for key in ("segment_rollups", "metrics"):
        if key not in declared:
            raise ConfigError(f"registry lacks {key!r}")
    rollups = declared["segment_rollups"]
    well_formed = isinstance(rollups, list) and all(
        isinstance(r, list) and all(isinstance(name, str) for name in r) for r in rollups
    )
    if not well_formed:
        raise ConfigError("segment_rollups must be a list of lists of column names")
    return Registry(tuple(metric(m) for m in declared["metrics"] or []), tuple(tuple(r) for r in rollups))


def rollup_label(rollup) -> str:
    return "_".join(["date", *rollup]) if rollup else "date_only"


def read_yaml(path: str) -> dict[str, Any]:
    """A YAML declaration file; the parser is only needed when files are used."""
    import yaml

    with open(path, encoding="utf-8") as handle:
        return yaml.safe_load(handle) or {}


def load_registry(path: str) -> Registry:
    return registry(read_yaml(path))


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str = "string"
    required: bool = True
    aliases: tuple[str, ...] = ()


@dataclass(frozen=True)
class FactSchema:
    base: tuple[ColumnSpec, ...]
    segments: tuple[ColumnSpec, ...] = ()
    conditions: tuple[ColumnSpec, ...] = ()

    @property
    def all(self) -> tuple[ColumnSpec, ...]:
        return self.base + self.segments + self.conditions


def fact_schema(declared: dict[str, Any]) -> FactSchema:
    def specs(section: str) -> tuple[ColumnSpec, ...]:
        return tuple(
            ColumnSpec(d["name"], d.get("type", "string"), d.get("required", True), tuple(d.get("aliases", ())))
            for d in declared.get(section, [])
        )

    return FactSchema(specs("base_columns"), specs("segment_columns"), specs("condition_columns"))


def load_schema(path: str) -> FactSchema:
    return fact_schema(read_yaml(path))


def load_intake_config(path: str) -> IntakeConfig:
    return intake_config(read_yaml(path))


@dataclass
class ColumnRule:
    rename: str | None = None
    type: str | None = None
    nullable: bool = True


@dataclass
class IntakeConfig:
    required_columns: list[str] = field(default_factory=list)
    null_threshold: float = 0.3
    duplicate_threshold: float = 0.3
    output_format: str = "csv"
    block_export_on_fail: bool = False
    columns: dict[str, ColumnRule] = field(default_factory=dict)
    table_mode: str = "replace"
    select_columns: list[str] = field(default_factory=list)


# Keys of such declarations that steer a command line, not the data; and one of another name.
COMMAND_KEYS = {"output_dir", "run_validate", "run_profile", "sheet"}
RENAMED_KEYS = {"db_mode": "table_mode"}


def intake_config(declared: dict[str, Any]) -> IntakeConfig:
    """The configuration of an intake run; keys for a command line are accepted and left aside."""
    values = {RENAMED_KEYS.get(k, k): v for k, v in declared.items() if k not in COMMAND_KEYS}
    unknown = sorted(set(values) - set(IntakeConfig.__dataclass_fields__))
    if unknown:
        raise ConfigError(f"unknown configuration keys: {unknown}")
    values["columns"] = {k: ColumnRule(**v) for k, v in (values.get("columns") or {}).items()}
    return IntakeConfig(**values)


# The two shipped metric sets and their column names.
MARKET_METRICS = registry({
    "segment_rollups": [[], ["region"], ["provider"], ["region", "provider"]],
    "metrics": [
        {"id": "total_revenue", "label": "Total Revenue", "type": "sum", "unit": "USD", "decimals": 0,
         "description": "Sum of all revenue across selected period", "source_col": "revenue"},
        {"id": "capacity_mw", "label": "Total Capacity (MW)", "type": "sum", "unit": "MW", "decimals": 1,
         "description": "Sum of installed capacity in megawatts", "source_col": "capacity_mw"},
        {"id": "leased_mw", "label": "Total Leased (MW)", "type": "sum", "unit": "MW", "decimals": 1,
         "description": "Sum of leased megawatts", "source_col": "leased_mw"},
        {"id": "contracted_kw", "label": "Total Contracted (KW)", "type": "sum", "unit": "KW", "decimals": 0,
         "description": "Sum of contracted kilowatts", "source_col": "contracted_kw"},
        {"id": "utilization_pct", "label": "Utilization Rate", "type": "ratio", "unit": "%", "decimals": 1,
         "description": "Percentage of capacity that is leased (leased_mw / capacity_mw * 100)",
         "numerator": "leased_mw", "denominator": "capacity_mw", "scale": 100},
        {"id": "avg_price_per_kw", "label": "Average Price per KW", "type": "per_unit", "unit": "USD/KW", "decimals": 2,
         "description": "Revenue divided by contracted kilowatts",
         "numerator": "revenue", "denominator": "contracted_kw"},
    ],
})

READINESS_METRICS = registry({
    "segment_rollups": [[], ["category"], ["market"], ["category", "market"]],
    "metrics": [
        {"id": "total_requirement_count", "label": "Total Requirement Count", "type": "count", "unit": "requirements",
         "decimals": 0, "description": "Total number of requirements in scope"},
        {"id": "open_gap_count", "label": "Open Gap Count", "type": "conditional_count", "unit": "gaps",
         "decimals": 0, "description": "Requirements that are not yet complete",
         "source_col": "status", "condition_values": ["open", "in_progress", "not_started"]},
        {"id": "critical_item_count", "label": "Critical Item Count", "type": "conditional_count", "unit": "items",
         "decimals": 0, "description": "Requirements or gaps marked critical",
         "source_col": "severity", "condition_values": ["critical"]},
        {"id": "readiness_completion_pct", "label": "Readiness Completion %", "type": "completion_pct", "unit": "%",
         "decimals": 1, "description": "Percentage of requirements marked complete or closed",
         "source_col": "status", "complete_values": ["complete", "closed"], "scale": 100},
    ],
})

MARKET_SCHEMA = fact_schema({
    "base_columns": [
        {"name": "date", "type": "date", "aliases": ["Date", "report_date", "Period"]},
        {"name": "revenue", "type": "float", "aliases": ["Revenue", "total_revenue", "rev"]},
        {"name": "capacity_mw", "type": "float", "aliases": ["Capacity_MW", "cap_mw", "Capacity"]},
        {"name": "leased_mw", "type": "float", "aliases": ["Leased_MW", "leasedmw"]},
        {"name": "contracted_kw", "type": "float", "aliases": ["Contracted_KW", "kw_contracted"]},
    ],
    "segment_columns": [
        {"name": "region", "required": False, "aliases": ["Region", "geo"]},
        {"name": "provider", "required": False, "aliases": ["Provider", "vendor"]},
    ],
})

READINESS_SCHEMA = fact_schema({
    "base_columns": [
        {"name": "date", "type": "date", "aliases": ["Date", "assessment_date", "report_date", "Period"]},
    ],
    "segment_columns": [
        {"name": "category", "required": False, "aliases": ["Category", "dimension", "track"]},
        {"name": "market", "required": False, "aliases": ["Market", "region", "geo"]},
    ],
    "condition_columns": [
        {"name": "status", "aliases": ["Status", "requirement_status", "readiness_status"]},
        {"name": "severity", "aliases": ["Severity", "priority", "criticality"]},
    ],
})
