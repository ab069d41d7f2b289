"""Named source specs and their registry.

A spec says where a dataset lives, in which format, where it lands and how it
is loaded. A child spec may name a base spec in ``source_key``: it inherits
every field of the base and its own fields win.
"""
from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any

from sluice.context import basename


@dataclass(frozen=True)
class SourceSpec:
    key: str
    path: str | None = None
    format: str | None = None
    target: str | None = None
    technique: str | None = None
    description: str = ""
    column_comments: Mapping[str, str] = field(default_factory=dict)
    schema: Any = None
    options: Mapping[str, str] = field(default_factory=dict)
    has_audit_columns: bool = False
    rescue: str | None = None  # column for fields that the schema lacks and values that don't fit it
    source_key: str | None = None

    @property
    def source_file(self) -> str:
        """What the audit column ``source_file`` holds for this source."""
        return basename(self.path or "")

    @property
    def target_name(self) -> str:
        """Last part of the target name (``cat.bronze.events`` → ``events``)."""
        return (self.target or self.key).rsplit(".", 1)[-1]

    def target_path(self, root: str) -> str:
        """Folder of the target under ``root``: dotted name parts become folders."""
        return f"{root.rstrip('/')}/{(self.target or self.key).replace('.', '/')}"


_FIELDS = {f.name for f in fields(SourceSpec)}


class Registry:
    """Key → spec, with ``source_key`` inheritance resolved on lookup."""

    def __init__(self, entries: Mapping[str, Mapping[str, Any] | SourceSpec] | None = None):
        self._raw: dict[str, dict[str, Any]] = {}
        for key, entry in (entries or {}).items():
            self.add(key, entry)

    def add(self, key: str, entry: Mapping[str, Any] | SourceSpec) -> None:
        if isinstance(entry, SourceSpec):
            entry = {f: getattr(entry, f) for f in _FIELDS if f != "key"}
        unknown = set(entry) - _FIELDS
        if unknown:
            raise ValueError(f"Unknown fields for source '{key}': {sorted(unknown)}")
        self._raw[key] = {k: v for k, v in entry.items() if v is not None}

    def keys(self) -> list[str]:
        return sorted(self._raw)

    def get(self, key: str) -> SourceSpec:
        if key not in self._raw:
            raise KeyError(f"source {key!r} is not registered; Known keys: {self.keys()}")
        entry = dict(self._raw[key])
        seen = {key}
        parent = entry.get("source_key")
        while parent:
            if parent not in self._raw:
                raise KeyError(f"source {key!r} inherits from unknown source_key {parent!r}")
            if parent in seen:
                raise ValueError(f"source_key cycle at '{parent}'")
            seen.add(parent)
            base = self._raw[parent]
            entry = {**base, **entry, "source_key": base.get("source_key")}
            parent = entry.get("source_key")
        entry.pop("source_key", None)
        return SourceSpec(key=key, source_key=self._raw[key].get("source_key"), **entry)
