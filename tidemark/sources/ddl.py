"""Table schemas from CREATE TABLE statements."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

from tidemark.functions.mapping import spark_type

_TABLE = re.compile(r"CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?([\w.\"]+)\s*\(", re.IGNORECASE)
_KEY = re.compile(r"PRIMARY\s+KEY\s*\(([^)]*)\)", re.IGNORECASE)
_COLUMN = re.compile(r"^\"?(\w+)\"?\s+([A-Za-z]\w*(?:\s*\([^)]*\))?)(.*)$", re.DOTALL)
_NOT_COLUMNS = ("CONSTRAINT", "PRIMARY", "UNIQUE", "FOREIGN", "CHECK")


@dataclass(frozen=True)
class TableSchema:
    name: str
    key: tuple[str, ...]
    schema: T.StructType
    declared: dict[str, str]


def _parts(body: str) -> list[str]:
    """The comma-separated parts of a table's body; commas within parentheses don't separate."""
    depth, start, out = 0, 0, []
    for i, c in enumerate(body):
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            out.append(body[start:i])
            start = i + 1
    return [p.strip() for p in [*out, body[start:]] if p.strip()]


def parse(sql: str) -> dict[str, TableSchema]:
    """Every table of a script by its name in upper case, without a schema prefix. Keys of several columns and precisions are kept."""
    sql = re.sub(r"--[^\n]*|/\*.*?\*/", "", sql, flags=re.DOTALL)
    found = {}
    for m in _TABLE.finditer(sql):
        depth, end = 1, m.end()
        while depth and end < len(sql):
            depth += (sql[end] == "(") - (sql[end] == ")")
            end += 1
        key: list[str] = []
        fields, declared = [], {}
        for part in _parts(sql[m.end() : end - 1]):
            if (k := _KEY.search(part)) and part.upper().startswith(_NOT_COLUMNS):
                key = [c.strip().strip('"').upper() for c in k[1].split(",")]
            elif not part.upper().startswith(_NOT_COLUMNS) and (c := _COLUMN.match(part)):
                name = c[1].upper()
                declared[name] = re.sub(r"\s+", "", c[2]).upper()
                fields.append(T.StructField(name, spark_type(c[2]), "NOT NULL" not in c[3].upper()))
                if "PRIMARY KEY" in c[3].upper():
                    key.append(name)
        name = m[1].replace('"', "").split(".")[-1].upper()
        found[name] = TableSchema(name, tuple(key), T.StructType(fields), declared)
    return found
