"""Jobs declared in YAML: defaults, tables, and the plan each table's spec stands for."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import types as T

from tidemark.functions.mapping import expression, spark_type
from tidemark.operators.envelope import ENVELOPE, envelope_schema

log = logging.getLogger(__name__)
#: What a table must declare, and what holds where neither it nor the defaults do.
REQUIRED = ("job_name", "target_table", "key", "source_schema")
FALLBACK = {"enabled": True, "starting_offsets": "earliest", "max_offsets_per_trigger": 100_000, "trigger_seconds": 3, "fail_on_data_loss": False, "time_column": None, "topic_prefix": "", "checkpoint_base": "checkpoints", "time_unit": "ms"}


@dataclass(frozen=True)
class TableSpec:
    job_name: str
    topic: str
    target_table: str
    key: str
    source_schema: dict[str, str]
    mapping: dict[str, str | None]
    time_column: str | None = None
    checkpoint: str = ""
    settings: dict = field(default_factory=dict)
    envelope: T.StructType = ENVELOPE

    @property
    def row_type(self) -> T.StructType:
        """The image's struct: epochs as numbers, decimals as declared."""
        def wire(kind: str) -> T.DataType:
            return T.LongType() if kind.strip().upper().startswith(("DATE", "TIMESTAMP")) else spark_type(kind)
        return T.StructType([T.StructField(n, wire(k)) for n, k in self.source_schema.items()])

    @property
    def source_key(self) -> str:
        """The key's name in the image: the column it is mapped from, if it is a plain rename."""
        to = self.mapping.get(self.key) or self.key
        return to if to in self.source_schema else self.key


def resolve(table: dict, defaults: dict | None = None) -> TableSpec:
    """A table's spec: what it declares goes before the defaults. Raises ValueError for missing fields and bad mappings."""
    merged = FALLBACK | (defaults or {}) | {k: v for k, v in table.items() if v is not None}
    missing = [f for f in REQUIRED if not merged.get(f)]
    topic = merged.get("topic") or (f"{merged['topic_prefix']}.{merged['topic_suffix']}".lstrip(".") if merged.get("topic_suffix") else None)
    if missing or not topic:
        raise ValueError(f"{table.get('job_name', 'a table')} lacks {', '.join([*missing, *['topic'] * (not topic)])}")
    mapping = merged.get("mapping") or {c: c for c in merged["source_schema"]}
    for value in mapping.values():
        if value is not None:
            expression(value)
    shape = envelope_schema(merged["envelope_schema"]) if merged.get("envelope_schema") else ENVELOPE
    return TableSpec(
        merged["job_name"], topic, merged["target_table"], merged["key"], dict(merged["source_schema"]), dict(mapping), merged["time_column"],
        f"{merged['checkpoint_base'].rstrip('/')}/{merged['job_name']}", {k: merged[k] for k in FALLBACK}, shape,
    )


def load(text: str) -> list[TableSpec]:
    """The enabled tables of a YAML text; a table that isn't valid is logged and skipped."""
    import yaml

    config = yaml.safe_load(text) or {}
    specs = []
    for table in config.get("tables") or []:
        if not (FALLBACK | (config.get("defaults") or {}) | table).get("enabled", True):
            continue
        try:
            specs.append(resolve(table, config.get("defaults")))
        except ValueError as e:
            log.error("table skipped: %s", e)
    return specs


def checkpoints(specs: list[TableSpec]) -> list[str]:
    return [s.checkpoint for s in specs]
