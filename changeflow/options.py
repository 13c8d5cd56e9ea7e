"""Job options and the fixed values every stage shares."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# --- fixed values ---------------------------------------------------------
# These must stay exactly as they are for the output to match.
KEYWORDS = {
    "Author": "LastChangedBy",
    "Date": "LastChangedDate",
    "Revision": "LastChangedRevision",
    "File": "HeadURL",
    "Id": "Id",
}
ACTIONS = ("ADD", "DELETE", "EDIT", "BRANCH", "INTEGRATE", "PURGE")
PURGED_TEXT = "Placeholder for file purged by Perforce."
CLEANUP_LOG = "Deleting Empty Parent Directories"
CHANGE_INFO_TEXT = "Converted from original Perforce changelist "
SYMLINK_PREFIX = "link "
DUMP_HEADER = "SVN-fs-dump-format-version: 1\n\n"
PROP_LOG, PROP_AUTHOR, PROP_DATE = "svn:log", "svn:author", "svn:date"
PROP_KEYWORDS, PROP_EXECUTABLE = "svn:keywords", "svn:executable"
PROP_EOL, PROP_SPECIAL = "svn:eol-style", "svn:special"
# ---------------------------------------------------------------------------

MAX_ID = 2**31 - 1
SEMANTICS = ("faithful", "corrected")
Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Branch:
    """Maps paths under ``depot_prefix`` to ``target_prefix``.

    A smaller ``priority`` is tried first; equal priorities fall back to the longest prefix.
    """

    depot_prefix: str
    target_prefix: str
    priority: int = 0


@dataclass(frozen=True)
class Hooks:
    """DataFrame transforms run, in order, at four points of a job."""

    on_changelist: tuple[Transform, ...] = ()
    on_file: tuple[Transform, ...] = ()
    after_build: tuple[Transform, ...] = ()
    on_publish: tuple[Transform, ...] = ()

    @staticmethod
    def apply(df: DataFrame, transforms: tuple[Transform, ...]) -> DataFrame:
        for transform in transforms:
            df = df.transform(transform)
        return df


@dataclass(frozen=True)
class MigrationOptions:
    branches: tuple[Branch, ...]
    from_change: int = 0
    to_change: int = MAX_ID
    base_revision: int = 0
    numbering: str | Callable[[DataFrame, int], DataFrame] = "serial"
    semantics: str = "faithful"
    charset: str = "UTF-8"
    source_timezone: str = "UTC"
    add_change_info: bool = False
    change_info: str = CHANGE_INFO_TEXT
    munge_keywords: bool = False
    convert_eol: bool = False
    property_order: tuple[str, ...] = ()
    keyword_order: tuple[str, ...] = ()
    split_by: int = 0
    cleanup: bool = True
    skip_empty_cleanup: bool = False
    cleanup_author: str = "changeflow"
    cleanup_time: str | None = None
    restore: bool = False
    strict: bool = False
    # A segment of the dump holds at most this many bytes, unless one record alone is longer, and so many records.
    bytes_per_segment: int = 128 << 20
    records_per_segment: int = 100_000
    # Changes per step of a build; each step is marked as finished when it is written. 0: one step.
    changes_per_step: int = 65_536
    hooks: Hooks = field(default_factory=Hooks)

    def __post_init__(self) -> None:
        if self.semantics not in SEMANTICS:
            raise ValueError(f"semantics must be one of {SEMANTICS}")
        if not callable(self.numbering) and self.numbering not in ("serial", "identity"):
            raise ValueError("numbering must be 'serial', 'identity' or a callable")
        if self.split_by < 0 or self.changes_per_step < 0:
            raise ValueError("split_by and changes_per_step must be >= 0")
        if self.records_per_segment < 1 or self.bytes_per_segment < 2:
            raise ValueError("a segment must have room for a record")

    @property
    def corrected(self) -> bool:
        return self.semantics == "corrected"
