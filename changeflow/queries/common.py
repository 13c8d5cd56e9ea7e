"""The derived change log and the frames most queries start from."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.paths import is_wanted
from changeflow.operators import changes, lineage, nodes
from changeflow.operators.numbering import number_changes
from changeflow.options import MigrationOptions
from changeflow.session import stage
from changeflow.sources import event_log
from changeflow.sources.tables import ChangeLog, SharedContents

OPTIONS = MigrationOptions(branches=event_log.BRANCHES, cleanup_time="2024-12-31 00:00:00")


class Log:
    """Lazy frames of one job over the derived change log."""

    def __init__(self, spark: SparkSession, sf_dir: str, options: MigrationOptions = OPTIONS, keyword_line=False):
        self.spark, self.sf_dir, self.options, self.keyword_line = spark, sf_dir, options, keyword_line

    @cached_property
    def rows(self) -> DataFrame:
        """File rows as a stored table, the way a real job would find them."""
        return stage(event_log.event_rows(self.spark, self.sf_dir), "file-rows")

    @cached_property
    def revised(self) -> DataFrame:
        """The same with revision numbers, stored too."""
        return stage(event_log.with_revisions(self.rows), "file-revisions")

    @cached_property
    def files(self) -> DataFrame:
        return event_log.file_revisions(self.revised)

    @cached_property
    def events(self) -> DataFrame:
        """File rows straight from the events, for queries that pass over them once."""
        return event_log.event_rows(self.spark, self.sf_dir).select(
            "change_id", "file_ord", "depot_path", "action", "file_type"
        )

    @cached_property
    def wanted_events(self) -> DataFrame:
        return changes.wanted_files(self.events, self.options)

    @cached_property
    def wanted(self) -> DataFrame:
        return changes.wanted_files(self.files, self.options)

    @cached_property
    def changelists(self) -> DataFrame:
        return event_log.changelists(self.spark, self.sf_dir)

    @cached_property
    def marked(self) -> DataFrame:
        return changes.mark_kept(self.changelists, changes.wanted_files(self.rows, self.options))

    @cached_property
    def numbered(self) -> DataFrame:
        return number_changes(self.marked, self.options)

    @cached_property
    def revisions(self) -> DataFrame:
        return self.numbered.select("change_id", "revision")

    @cached_property
    def integrations(self) -> DataFrame:
        return stage(event_log.integrations(self.revised), "integrations")

    @cached_property
    def contents(self) -> SharedContents:
        return event_log.contents(self.spark, self.sf_dir, self.revised, self.keyword_line)

    @cached_property
    def prints(self) -> DataFrame:
        """Content fingerprints as a stored table, from one hash per document."""
        prints = event_log.fingerprints(self.spark, self.sf_dir, self.revised, self.keyword_line)
        return stage(prints.where(is_wanted(F.col("depot_path"), self.options.branches)), "fingerprints")

    @cached_property
    def copies(self) -> DataFrame:
        found = lineage.resolve_copies(
            self.wanted, self.files, self.integrations, self.prints, self.revisions, self.options
        )
        return stage(found, "copies")

    @cached_property
    def nodes(self) -> DataFrame:
        return nodes.change_nodes(self.wanted, self.copies, self.options)

    @cached_property
    def records(self) -> DataFrame:
        """Node records as a stored table, which is what replay reads."""
        return stage(self.nodes, "node-records")

    @cached_property
    def replay_records(self) -> DataFrame:
        """The same with the columns that replay reads, so that no others are joined, numbered and stored."""
        narrow = self.nodes.select("change_id", "part", "path", "change_action", "node_kind")
        return stage(narrow, "replay-records")

    @cached_property
    def headers(self) -> DataFrame:
        return nodes.header_nodes(self.changelists, self.numbered, self.options)

    @property
    def change_log(self) -> ChangeLog:
        return ChangeLog(self.changelists, self.files, self.contents, self.integrations)
