"""Path expressions: prefix mapping, parents and ancestors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.options import Branch

# Fixed value: the characters stripped around a path before it is cut into parents.
BLANKS = "".join(chr(c) for c in range(0x21))
# A no-break space is written out as two characters.
NBSP, NBSP_TARGET = "\u00a0", "\u00c2\u00a0"

def ranked(branches: Sequence[Branch]) -> list[Branch]:
    """Branches in match order: priority first, then longest prefix."""
    return sorted(branches, key=lambda b: (b.priority, -len(b.depot_prefix), b.depot_prefix))


def replace_prefix(path: Column, branch: Branch) -> Column:
    return F.concat(
        F.lit(branch.target_prefix), F.substring(path, len(branch.depot_prefix) + 1, 2**31 - 1)
    )


def widen_nbsp(path: Column) -> Column:
    return F.replace(path, F.lit(NBSP), F.lit(NBSP_TARGET))


def map_prefix(path: Column, branches: Sequence[Branch]) -> Column:
    """Target path of the first branch whose prefix matches, NULL when none does.

    For the handful of branches of a job's options; a table of branches goes through ``map_paths``.
    """
    order = ranked(branches)
    if not order:
        return F.lit(None).cast("string")
    return widen_nbsp(F.coalesce(*[F.when(path.startswith(b.depot_prefix), replace_prefix(path, b)) for b in order]))


def map_paths(df: DataFrame, branches: DataFrame, path_col: str = "depot_path", out: str = "svn_path") -> DataFrame:
    """Add the mapped path by a table (depot_prefix, target_prefix, priority) of any size; NULL where no prefix fits.

    Each distinct path is cut once per prefix length that occurs, and the cuts meet the prefixes by equality. Of the
    branches that fit, the one of least priority counts, then the longest, then the least target.
    """
    best = F.min(F.struct("priority", (-F.length("depot_prefix")).alias("_short"), "target_prefix")).alias("_b")
    # Repeated prefixes fold to the one that counts.
    table = branches.groupBy("depot_prefix").agg(best).select("depot_prefix", "_b.*")
    # Bounded by the length of the longest prefix, whatever the number of branches.
    lengths = [r[0] for r in table.select(F.length("depot_prefix")).distinct().collect()]
    path = F.col("_path")
    widths = F.filter(F.array(*map(F.lit, sorted(lengths))).cast("array<int>"), lambda n: n <= F.length(path))
    cuts = (
        df.select(F.col(path_col).alias("_path"))
        .where(path.isNotNull())
        .distinct()
        .select("_path", F.explode(widths).alias("_n"))
        .select("_path", F.substr(path, F.lit(1), F.col("_n")).alias("depot_prefix"))
    )
    first = cuts.join(table, "depot_prefix").groupBy("_path").agg(
        F.min(F.struct("priority", "_short", "target_prefix")).alias("_b")
    )
    mapped = F.concat(F.col("_b.target_prefix"), F.substr(path, 1 - F.col("_b._short")))
    found = first.select("_path", widen_nbsp(mapped).alias(out))
    return df.join(found, df[path_col] == found["_path"], "left").drop("_path")


def is_wanted(path: Column, branches: Sequence[Branch]) -> Column:
    """Same rows as ``map_prefix(...) IS NOT NULL``, in a form that file scans can push down."""
    if not branches:
        return F.lit(False)
    return reduce(
        lambda a, b: a | b, [path.startswith(p) for p in sorted({b.depot_prefix for b in branches})]
    )


def parent_of(path: Column) -> Column:
    """Directory part of a path, with its trailing slash; NULL at the top."""
    found = F.regexp_extract(F.btrim(path, F.lit(BLANKS)), r"(?s)^(.*/).", 1)
    return F.when(found != "", found)


def ancestors_of(path: Column) -> Column:
    """All parents of a path, shortest first."""
    names = F.split(F.btrim(path, F.lit(BLANKS)), "/", -1)
    # "a/b" has one parent; "a/b/" also has one, since its last name is empty.
    depth = F.size(names) - F.when(F.element_at(names, -1) == "", 2).otherwise(1)
    return F.transform(
        F.slice(names, F.lit(1), F.greatest(depth, F.lit(0))),
        lambda _, i: F.concat(F.array_join(F.slice(names, F.lit(1), i + 1), "/"), F.lit("/")),
    )


def url_path(url: Column) -> Column:
    """Host and path of a URL: no scheme, query or fragment."""
    return F.regexp_replace(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://|[?#].*$", "")
