"""Rule files: YAML on the driver, checked against the schema before any job starts."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from pathlib import Path
from typing import Any

from pyspark.sql import Column, functions as F, types as T

from siftgate.functions.values import Field

RULE_PACK = Path(__file__).parent / "rulepack"

PLATFORM_SLOT = "{{ platform }}"


class RuleError(ValueError):
    """A rule does not fit the table or names an unknown check."""


@dataclass(frozen=True)
class Rule:
    id: str
    check: str
    column: str | None = None
    params: dict[str, Any] = field(default_factory=dict)
    scope: str = "row"
    when: str | None = None
    severity: str = "error"
    on_fail: str = "report_only"
    description: str = ""
    force_escalate_above: float | None = None

    @property
    def definition(self) -> tuple:
        """Rules of several platforms with equal definitions share one expression."""
        return (self.id, self.check, self.column, repr(sorted(self.params.items(), key=lambda p: p[0])),
                self.scope, self.when, self.severity, self.on_fail, self.description,
                self.force_escalate_above)


@dataclass(frozen=True)
class RuleSet:
    dataset: str = "unknown"
    platform: str = "unknown"
    crawl_key: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()

    @classmethod
    def from_dict(cls, spec: dict[str, Any]) -> "RuleSet":
        platform = spec.get("platform") or ""
        rules = []
        for raw in spec.get("rules") or []:
            unknown = set(raw) - set(Rule.__dataclass_fields__)
            if unknown:
                raise RuleError(f"rule {raw.get('id')!r} has unknown keys {sorted(unknown)}")
            rule = Rule(**{k: v for k, v in raw.items() if v is not None})
            params = {k: v.replace(PLATFORM_SLOT, platform) if isinstance(v, str) else v
                      for k, v in rule.params.items()}
            rules.append(replace(rule, params=params, description=" ".join(rule.description.split())))
        return cls(spec.get("dataset", "unknown"), spec.get("platform") or "unknown",
                   tuple(spec.get("crawl_key") or ()), tuple(rules))

    def with_rules(self, *rules: Rule) -> "RuleSet":
        return replace(self, rules=tuple(rules))

    def row_rules(self) -> list[Rule]:
        return [r for r in self.rules if r.scope == "row"]

    def group_rules(self) -> list[Rule]:
        return [r for r in self.rules if r.scope != "row"]

    def get(self, rule_id: str) -> Rule:
        for r in self.rules:
            if r.id == rule_id:
                return r
        raise RuleError(f"no rule {rule_id!r} for {self.dataset}/{self.platform}")


def read_rule_text(path: Path) -> dict[str, Any]:
    text = path.read_text(encoding="utf-8")
    try:
        import yaml
    except ImportError:  # JSON is a subset of YAML, so JSON rule files still load
        import json
        return json.loads(text)
    return yaml.safe_load(text) or {}


def merged_spec(path: Path, root: Path) -> dict[str, Any]:
    """Child settings over the inherited file; a child rule takes the place of its namesake."""
    spec = read_rule_text(path)
    parent = spec.pop("extends", None)
    if parent is None:
        return spec
    base = merged_spec(root / parent, root)
    by_id = {r["id"]: r for part in (base, spec) for r in part.get("rules") or []}
    return {**base, **spec, "rules": list(by_id.values())}


def load_rules(path: str | Path, root: str | Path | None = None) -> RuleSet:
    path = Path(path)
    return RuleSet.from_dict(merged_spec(path, Path(root) if root else path.parent.parent))


def shipped_rules(name: str) -> RuleSet:
    """A rule set of the built-in pack, e.g. ``visibility/amazon``."""
    return load_rules(RULE_PACK / f"{name}.yaml", RULE_PACK)


def predicate(text: str) -> Column:
    """Spark SQL condition. List literals in square brackets are accepted after IN."""
    return F.expr(re.sub(r"(?i)\bin\s*\[([^\]]*)\]", r"in (\1)", text))


def guard(rule: Rule) -> Column:
    """Rows the rule applies to; an unknown guard means it does not."""
    if not rule.when:
        return F.lit(True)
    return F.coalesce(predicate(rule.when), F.lit(False))


def field_of(schema: T.StructType, rule: Rule) -> Field | None:
    if rule.column is None:
        return None
    if rule.column not in schema.names:
        raise RuleError(f"rule {rule.id!r} reads missing column {rule.column!r}")
    return Field(rule.column, schema[rule.column].dataType)


def crawl_columns(columns: list[str], crawl_key: tuple[str, ...] | list[str]) -> list[str]:
    """Crawl keys that the table really has; with none left all rows are one group."""
    return [k for k in crawl_key if k in columns]
