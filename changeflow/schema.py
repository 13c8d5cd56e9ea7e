"""Canonical table schemas."""

from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, IntegerType, LongType, MapType, StringType, StructField, StructType,
    TimestampNTZType,
)


def _table(**columns):
    return StructType([StructField(name, kind) for name, kind in columns.items()])


_int, _long, _str, _bin = IntegerType(), LongType(), StringType(), BinaryType()
_content_ref = _table(depot_path=_str, rev=_int)

CHANGELISTS = _table(change_id=_int, username=_str, submitted_at=TimestampNTZType(), description=_str)
FILE_REVISIONS = _table(
    change_id=_int, file_ord=_int, depot_path=_str, rev=_int, action=_str, file_type=_str
)
CONTENTS = _table(depot_path=_str, rev=_int, content=_bin, missing=BooleanType())
CONTENTS_BY_CHANGE = _table(depot_path=_str, rev=_int, content=_bin, missing=BooleanType(), change_id=_int)
INTEGRATIONS = _table(
    to_path=_str, to_rev=_int, seq=_int, how_from=_str, from_path=_str, end_from_rev=_int
)
BRANCHES = _table(depot_prefix=_str, target_prefix=_str, priority=_int)
REVISION_MAP = _table(change_id=_int, revision=_int)
NODE_RECORDS = _table(
    change_id=_int, part=_int, path=_str, change_action=_str, node_kind=_str, node_action=_str,
    copy_from_path=_str, copy_from_rev=_int, props=MapType(_str, _str), content_form=_str,
    content_ref=_content_ref, revision=_int,
)
DIR_USAGE = _table(path=_str, usage=_long)
PATH_STATUS = _table(path=_str, status=_int)
EMPTY_DIRS = _table(path=_str, empty=_int)
FINGERPRINTS = _table(depot_path=_str, rev=_int, n_bytes=_int, digest=_str)
COPIES = _table(change_id=_int, file_ord=_int, copy_from_path=_str, copy_from_rev=_int)
LAYER = _table(folder=_str, rows=_long, buckets=_int)
RUN_META = _table(run_id=_str, last_change_id=_int, last_revision=_int, layers=MapType(_str, ArrayType(LAYER)))
COMPLETED = _table(change_id=_int, fingerprint=_str, batch=_str)
HASHED = _table(low=_int, high=_int, fingerprint=_str, batch=_str)
SOURCES = _table(from_path=_str, from_rev=_int, from_change_id=_int)
ASKED = _table(change_id=_int, file_ord=_int, to_path=_str, to_rev=_int, from_path=_str, from_rev=_int)
DUMP_RECORDS = _table(
    split_id=_int, segment=_long, change_id=_int, part=_int, record=_bin
)
