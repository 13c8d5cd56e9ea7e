import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from changeflow.functions import filetypes
from changeflow.functions.records import property_block, property_map
from changeflow.functions.text import (
    byte_length, change_log_text, gmt_date, keyword_list, munge_keywords, to_bytes,
)
from changeflow.options import Branch, MigrationOptions

OPTIONS = MigrationOptions(branches=(Branch("//d/", "t/"),))

# type: (keywords, executable) faithful, then corrected
FLAGS = {
    "k": (True, False, True, False),
    "ktext": (False, False, True, False),
    "text+k": (False, False, True, False),
    "+k": (True, False, True, False),
    "+xk": (True, False, True, True),
    "text": (False, False, False, False),
    "unicode": (False, False, False, False),
    "text+x": (False, False, False, True),
    "xtext": (False, False, False, True),
    "x": (False, True, False, True),
    "kx": (False, True, True, True),
    "+x": (False, True, False, True),
    "cx": (False, True, False, True),
    "xbinary+k": (False, False, True, True),
    "text\n": (False, False, False, False),
    "k\n": (False, False, True, False),
}


def test_type_flags(spark):
    df = spark.createDataFrame([(t,) for t in FLAGS], "t string")
    t = F.col("t")
    rows = df.select(
        "t", filetypes.expands_keywords(t), filetypes.is_executable(t),
        filetypes.expands_keywords(t, "corrected"), filetypes.is_executable(t, "corrected"),
    ).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == FLAGS
    texts = [r[0] for r in df.where(filetypes.is_text(t)).collect()]
    assert sorted(texts) == ["text", "unicode"]


def test_munging_hits_bare_words_and_keeps_other_bytes(spark):
    content = b"$Author$ Dates Id\xff\x00 File Revision"
    row = spark.createDataFrame([(bytearray(content),)], "c binary").select(munge_keywords(F.col("c"))).first()
    assert bytes(row[0]) == b"$LastChangedBy$ LastChangedDates Id\xff\x00 HeadURL LastChangedRevision"


def test_keyword_order():
    assert keyword_list() == "HeadURL Id LastChangedBy LastChangedDate LastChangedRevision"
    assert keyword_list(("Id", "HeadURL")).startswith("Id HeadURL ")


@pytest.mark.parametrize("zone,expected", [
    ("UTC", "2024-03-10T02:30:00.000000Z"),
    ("Asia/Tokyo", "2024-03-09T17:30:00.000000Z"),
])
def test_gmt_date_ignores_session_zone_and_fraction(spark, zone, expected):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 0, 123456),)], "t timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(gmt_date(F.col("t"), zone)).first()[0] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_charsets(spark):
    df = spark.createDataFrame([("é€",)], "s string")
    row = df.select(
        to_bytes(F.col("s")), to_bytes(F.col("s"), "ISO-8859-1"), byte_length(F.col("s")),
        byte_length(F.col("s"), "ISO-8859-1"),
    ).first()
    assert (bytes(row[0]), bytes(row[1]), row[2], row[3]) == ("é€".encode(), b"\xe9?", 5, 2)


def test_description_suffix(spark):
    df = spark.createDataFrame([("text", 7), (None, 8)], "d string, c int")
    rows = df.select(
        change_log_text(F.col("d"), F.col("c")), change_log_text(F.col("d"), F.col("c"), True, "from ")
    ).collect()
    assert [tuple(r) for r in rows] == [("text", "text\nfrom 7"), ("", "\nfrom 8")]


def test_property_block_counts_bytes(spark):
    df = spark.createDataFrame([({"b": "é", "a": ""},), ({},), (None,)], "p map<string,string>")
    rows = [r[0] for r in df.select(property_block(F.col("p"))).collect()]
    assert rows == ["K 1\na\nV 0\n\nK 1\nb\nV 2\né\nPROPS-END", "PROPS-END", "PROPS-END"]
    ordered = df.select(property_block(F.col("p"), "UTF-8", ("b",))).first()[0]
    assert ordered == "K 1\nb\nV 2\né\nK 1\na\nV 0\n\nPROPS-END"


def test_property_map(spark):
    from dataclasses import replace

    df = spark.createDataFrame([("k",), ("x",), ("text",), ("binary",)], "t string")
    eol = replace(OPTIONS, convert_eol=True)
    rows = df.select(property_map(F.col("t"), eol), property_map(F.col("t"), OPTIONS, F.lit(True))).collect()
    assert [r[0] for r in rows] == [
        {"svn:keywords": keyword_list()}, {"svn:executable": "on"}, {"svn:eol-style": "native"}, {},
    ]
    assert rows[3][1] == {"svn:special": "*"}


def test_md5_matches_python(spark):
    raw = bytes(range(256))
    row = spark.createDataFrame([(bytearray(raw),)], "c binary").select(F.md5("c")).first()
    assert row[0] == hashlib.md5(raw).hexdigest()


def test_options_are_checked():
    with pytest.raises(ValueError):
        MigrationOptions(branches=(), semantics="other")
    with pytest.raises(ValueError):
        MigrationOptions(branches=(), numbering="other")
