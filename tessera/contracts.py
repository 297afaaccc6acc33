"""Contracts of tables: what each column may hold, limits, and how they are read from TOML."""

from __future__ import annotations

import hashlib
import json
import re
import tomllib
from dataclasses import asdict, dataclass, field, fields

from tessera.errors import UsageError
from tessera.types import Declared, parse_type

FREEDOMS = ("open", "constrained", "closed")


@dataclass(frozen=True)
class Limits:
    """Caps; none may be zero, for that would switch a control off."""

    max_field_bytes: int = 1 << 20
    max_elements: int = 4096
    max_depth: int = 8
    max_decode_rounds: int = 1
    max_decode_expansion_ratio: int = 8

    def __post_init__(self) -> None:
        for f in fields(self):
            if getattr(self, f.name) <= 0:
                raise UsageError(f"{f.name} = {getattr(self, f.name)} disables a control")


@dataclass(frozen=True)
class ColumnContract:
    """One column: its type, byte cap, anchored pattern, allowed values, how free its text is."""

    name: str
    type: str
    max_len: int | None = None
    pattern: str | None = None
    allowed: tuple[str, ...] = ()
    approved: tuple[str, ...] = ()
    freedom: str = "closed"
    drop: bool = False
    provenance: str = ""

    def __post_init__(self) -> None:
        if self.freedom not in FREEDOMS:
            raise UsageError(f"{self.name}: freedom is one of {', '.join(FREEDOMS)}")
        if self.pattern is not None and not (self.pattern.startswith("^") and re.search(r"(?<!\\)(\$|\\z)\Z", self.pattern)):
            raise UsageError(f"{self.name}: a pattern starts with ^ and ends with $")
        if self.max_len is not None and self.max_len <= 0:
            raise UsageError(f"{self.name}: max_len is positive")
        object.__setattr__(self, "allowed", tuple(self.allowed))
        object.__setattr__(self, "approved", tuple(self.approved))
        parse_type(self.type)

    @property
    def declared(self) -> Declared:
        return parse_type(self.type)

    @property
    def nullable(self) -> bool:
        t = self.declared
        return t.nullable or (t.name == "LowCardinality" and t.inner[0].nullable)


@dataclass(frozen=True)
class TableContract:
    table: str
    columns: tuple[ColumnContract, ...]
    order_by: tuple[str, ...] = ()
    limits: Limits = field(default_factory=Limits)
    iocs: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        names = [c.name for c in self.columns]
        if len({n.lower() for n in names}) < len(names):
            raise UsageError(f"{self.table}: a column's name repeats")
        if names and all(c.drop for c in self.columns):
            raise UsageError(f"{self.table}: every column is dropped")
        if unknown := [n for n in self.order_by if n not in names]:
            raise UsageError(f"{self.table}: unknown columns in order_by: {', '.join(unknown)}")
        for c in self.columns:
            if c.declared.depth > self.limits.max_depth:
                raise UsageError(f"{self.table}.{c.name}: type is nested deeper than {self.limits.max_depth}")

    @property
    def kept(self) -> tuple[ColumnContract, ...]:
        return tuple(c for c in self.columns if not c.drop)

    @property
    def digest(self) -> str:
        """SHA-256 of the contract's canonical JSON."""
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def _build(cls, data: dict, where: str):
    known = {f.name for f in fields(cls)}
    if unknown := sorted(data.keys() - known):
        raise UsageError(f"{where}: unknown keys: {', '.join(unknown)}")
    return cls(**data)


def load_contract(text: str) -> TableContract:
    """A contract from TOML: table, order_by, iocs, [limits], [[columns]]; an unknown key is an error."""
    data = tomllib.loads(text)
    columns = tuple(_build(ColumnContract, c, "columns") for c in data.pop("columns", []))
    limits = _build(Limits, data.pop("limits", {}), "limits")
    data = {k: tuple(v) if isinstance(v, list) else v for k, v in data.items()}
    return _build(TableContract, data | {"columns": columns, "limits": limits}, "contract")


def check_policy_columns(policy: list[str], schema: list[str]) -> None:
    """Policy names that no column has are an error."""
    if unknown := sorted(set(policy) - set(schema)):
        raise UsageError(f"policy names unknown columns: {', '.join(unknown)}")


def cursor_columns(contract: TableContract) -> list[str]:
    """The prefix of the sort key up to its first nullable column; keyset paging needs one at least."""
    out: list[str] = []
    by_name = {c.name: c for c in contract.columns}
    for name in contract.order_by:
        if by_name[name].nullable or by_name[name].drop:
            break
        out.append(name)
    if not out:
        raise UsageError(f"{contract.table}: the sort key has no leading column without nulls")
    return out
