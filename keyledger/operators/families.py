"""Event families (U2): what the `$set` bodies of an event log hold and which of
their properties are tracked.  A caller describes a family and passes it to the
parse, the fold and the index; nothing else in the library knows its fields.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from keyledger import schemas
from keyledger.functions.constants import FIELDS, FIELD_ORDER


@dataclass(frozen=True)
class TrackedField:
    """A field that the fold keeps per id.

    ``prop``: its property inside `$set`, a dotted path where it lies deeper;
    ``prefix``: of its keys in the uniqueness index; ``removals``: the names in
    `$rem` that remove it (the property, if none are given)."""
    name: str
    prop: str
    prefix: str
    removals: tuple[str, ...] = ()

    @property
    def column(self) -> str:
        """The parsed column that holds the property."""
        return "set_" + self.prop.replace(".", "_")

    @property
    def removed_by(self) -> tuple[str, ...]:
        return self.removals or (self.prop,)


@dataclass(frozen=True)
class EventFamily:
    """``set_schema``: the declared `$set` body, or None for a family without
    one, whose bodies are read as VARIANT and asked for the tracked properties."""
    name: str
    fields: tuple[TrackedField, ...]
    set_schema: T.StructType | None = None

    @property
    def properties(self) -> list[str]:
        """The parsed `$set` columns: all declared properties, and tracked ones below them."""
        declared = [f"set_{f.name}" for f in self.set_schema.fields] if self.set_schema else []
        return declared + [f.column for f in self.fields if f.column not in declared]


def _known(name: str, set_schema: T.StructType) -> EventFamily:
    return EventFamily(name, tuple(TrackedField(f, FIELDS[f][1], FIELDS[f][2]) for f in FIELD_ORDER if FIELDS[f][0] == name), set_schema)


CORE = _known("core", schemas.CORE_SET)
CONTACT = _known("contact", schemas.CONTACT_SET)
FAMILIES = {f.name: f for f in (CORE, CONTACT)}
IDENTITY_FIELDS = tuple(sorted(CORE.fields + CONTACT.fields, key=lambda f: FIELD_ORDER.index(f.name)))


def family_of(family: str | EventFamily) -> EventFamily:
    """A family by itself, or one of the two identity families by name."""
    return family if isinstance(family, EventFamily) else FAMILIES[family]
