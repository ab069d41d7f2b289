"""Sources and sinks: named source specs and lossless text-format I/O."""
from sluice.sources.formats import read, register_format, write, known_formats
from sluice.sources.spec import Registry, SourceSpec

__all__ = ["read", "write", "register_format", "known_formats", "Registry", "SourceSpec"]
