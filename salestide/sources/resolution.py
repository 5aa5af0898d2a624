"""How records of all registered versions of a subject are read by one query, from the registry alone.

The registry's schema texts are records in Avro's JSON notation (fields with a type and perhaps a default). The reader's
schema holds every field that any version has: a field that later versions widen has its widest type, one that they drop
stays for the older records, one that they add takes its default in older ones. Each change is judged: whether
new readers can read old records (backward) and old readers new ones (forward).
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from salestide import contract as c
from salestide.operators.decode import decode_records
from salestide.session import local_table
from salestide.sources.registry import Registry, current

# A subject with more versions is refused: each is looked at on the driver.
MAX_VERSIONS = 1_000

# Avro's primitive types in Spark, and what each may be widened to.
_TYPES = {
    "string": c.STRING, "bytes": c.BINARY, "boolean": T.BooleanType(), "int": c.INT, "long": c.LONG,
    "float": T.FloatType(), "double": c.DOUBLE,
}
_WIDER = {"int": ("long", "float", "double"), "long": ("float", "double"), "float": ("double",)}

CHANGES = c.table(
    version=c.INT, field=c.STRING, change=c.STRING, was=c.STRING, now=c.STRING, backward=T.BooleanType(), forward=T.BooleanType()
)


class Incompatible(ValueError):
    """A version cannot be read together with an earlier one."""


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    default: object = None
    has_default: bool = False


@dataclass(frozen=True)
class Resolution:
    """The reader's schema, the fields that came later (name to first version and default), and every change."""

    reader: T.StructType
    added: Mapping[str, tuple[int, object]]
    changes: list[tuple]

    @property
    def compatible(self) -> bool:
        return all(change[5] for change in self.changes)

    def table(self, spark: SparkSession) -> DataFrame:
        return local_table(spark, self.changes, CHANGES)


def fields(text: str) -> dict[str, Field]:
    """The fields of a record schema by name. A union with null is its other type; its default may be null."""
    found = {}
    for field in json.loads(text)["fields"]:
        kind = field["type"]
        if isinstance(kind, list):
            rest = [k for k in kind if k != "null"]
            if len(rest) != 1:
                raise Incompatible(f"{field['name']}: a union of {kind} has no column type")
            kind = rest[0]
        if kind not in _TYPES:
            raise Incompatible(f"{field['name']}: type {kind} has no column type")
        found[field["name"]] = Field(field["name"], kind, field.get("default"), "default" in field)
    return found


def resolve(versions: list[tuple[int, str]]) -> Resolution:
    """One way to read all ``versions`` (number, schema text), in order of their numbers."""
    reader: dict[str, str] = {}
    since: dict[str, int] = {}
    defaults: dict[str, object] = {}
    changes: list[tuple] = []
    before: dict[str, Field] | None = None
    for number, text in sorted(versions):
        now = fields(text)
        for name, field in now.items():
            if name not in reader:
                reader[name], since[name] = field.kind, number
                if before is not None:
                    changes.append((number, name, "added", None, field.kind, field.has_default, True))
            elif field.kind != reader[name]:
                known = reader[name]
                if field.kind in _WIDER.get(known, ()):
                    reader[name] = field.kind
                    changes.append((number, name, "widened", known, field.kind, True, False))
                elif known in _WIDER.get(field.kind, ()):
                    changes.append((number, name, "narrowed", known, field.kind, True, True))
                else:
                    changes.append((number, name, "retyped", known, field.kind, False, False))
            if name in now and before is not None and name not in before and since[name] != number:
                changes.append((number, name, "restored", None, field.kind, field.has_default, True))
            if field.has_default:
                defaults[name] = field.default
        for name, field in (before or {}).items():
            if name not in now:
                changes.append((number, name, "dropped", field.kind, None, True, field.has_default))
        before = now
    first = min((number for number, _ in versions), default=0)
    added = {name: (number, defaults.get(name)) for name, number in since.items() if number > first}
    schema = T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in reader.items()])
    return Resolution(schema, added, changes)


def resolve_subject(registry: Registry, subject: str, max_versions: int = MAX_VERSIONS) -> Resolution:
    """The resolution of all versions that a registry has of a subject now."""
    rows = current(registry).filter(current(registry)["subject"] == subject).select("version", "schema").distinct()
    found = rows.limit(max_versions + 1).collect()
    if len(found) > max_versions:
        raise ValueError(f"more than {max_versions} versions of {subject}")
    return resolve([(row.version, row.schema) for row in found])


def decode_resolved(records: DataFrame, registry: Registry, subject: str) -> DataFrame:
    """Bronze of records of any registered version; raises :class:`Incompatible` if they cannot be read together."""
    resolution = resolve_subject(registry, subject)
    broken = [f"version {change[0]}: {change[1]} {change[2]}" for change in resolution.changes if not change[5]]
    if broken:
        raise Incompatible("; ".join(broken))
    return decode_records(records, registry, resolution.reader, subject, resolution.added)
