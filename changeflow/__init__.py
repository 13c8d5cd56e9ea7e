"""changeflow: replay and publish numbered change logs with Spark DataFrames."""

from changeflow.options import Branch, MigrationOptions

__all__ = ["Branch", "MigrationOptions"]
