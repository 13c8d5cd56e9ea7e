"""Text, byte and date expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from changeflow.options import CHANGE_INFO_TEXT, KEYWORDS

_NARROW = {"US-ASCII": r"[^\x00-\x7f]", "ISO-8859-1": r"[^\x00-\xff]"}


def to_bytes(value: Column, charset: str = "UTF-8") -> Column:
    """Encode text; characters outside a one-byte charset become ``?``."""
    if charset.upper() == "UTF-8":
        return value.cast("binary")
    outside = _NARROW.get(charset.upper())
    if outside:
        value = F.regexp_replace(value, outside, "?")
    return F.encode(value, charset)


def byte_length(value: Column, charset: str = "UTF-8") -> Column:
    return F.octet_length(to_bytes(value, charset))


def munge_keywords(content: Column, charset: str = "UTF-8") -> Column:
    """Swap each keyword for its target word, anywhere in the text of a binary column.

    The words are ASCII, so any ASCII-based charset is handled on the raw bytes.
    """
    wide = charset.upper().startswith(("UTF-16", "UTF-32"))
    text = F.decode(content, charset) if wide else content.cast("string")
    text = reduce(lambda t, kv: F.replace(t, F.lit(kv[0]), F.lit(kv[1])), KEYWORDS.items(), text)
    return F.encode(text, charset) if wide else text.cast("binary")


def keyword_list(order: tuple[str, ...] = ()) -> str:
    """The keyword property's value: target words, sorted unless an order is given."""
    words = sorted(KEYWORDS.values())
    return " ".join([w for w in order if w in words] + [w for w in words if w not in order])


def gmt_date(local_time: Column, timezone: str = "UTC") -> Column:
    """Zone-less local time as a GMT stamp with a fixed fraction."""
    utc = F.convert_timezone(F.lit(timezone), F.lit("UTC"), local_time)
    # Formatted from the zone-less value itself, so the session zone plays no part.
    stamp = F.substring(utc.cast("string"), 1, 19)
    return F.concat(F.replace(stamp, F.lit(" "), F.lit("T")), F.lit(".000000Z"))


def change_log_text(
    description: Column, change_id: Column, add_info: bool = False, info: str = CHANGE_INFO_TEXT
) -> Column:
    text = F.coalesce(description, F.lit(""))
    if add_info:
        text = F.concat(text, F.lit("\n" + info), change_id.cast("string"))
    return text


def missing_text(depot_path: Column, rev: Column) -> Column:
    """Stand-in content for a revision whose bytes are gone; the same on every run."""
    return F.concat(
        F.lit("Import Error: Failed to get file contents: "), depot_path, F.lit("#"), rev.cast("string")
    )
