"""Sources and sinks."""

from quarry.sources.tables import read_table  # noqa: F401
