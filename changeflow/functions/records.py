"""Property maps and the text layout of dump records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from changeflow import options as o
from changeflow.functions import filetypes
from changeflow.functions.text import byte_length, keyword_list, to_bytes


def property_map(
    file_type: Column, options: o.MigrationOptions, special: Column | None = None
) -> Column:
    """Properties implied by a file type; only the keys that apply are present."""
    semantics = options.semantics
    values = {
        o.PROP_EOL: F.when(F.lit(options.convert_eol) & filetypes.is_text(file_type), "native"),
        o.PROP_EXECUTABLE: F.when(filetypes.is_executable(file_type, semantics), "on"),
        o.PROP_KEYWORDS: F.when(
            filetypes.expands_keywords(file_type, semantics), keyword_list(options.keyword_order)
        ),
        o.PROP_SPECIAL: F.when(F.lit(False) if special is None else special, "*"),
    }
    entries = [F.when(v.isNotNull(), F.struct(F.lit(k).alias("key"), v.alias("value"))) for k, v in values.items()]
    return F.map_from_entries(F.array_compact(F.array(*entries)))


def property_block(
    props: Column, charset: str = "UTF-8", order: tuple[str, ...] = ()
) -> Column:
    """Key and value lines with their byte lengths, closed by the end mark."""
    entries = F.array_sort(F.map_entries(F.coalesce(props, F.create_map().cast("map<string,string>"))))
    if order:
        first = F.array(*[F.lit(k) for k in order])
        rank = lambda e: F.when(
            F.array_contains(first, e["key"]), F.array_position(first, e["key"]).cast("int")
        ).otherwise(len(order) + 1)
        entries = F.transform(
            F.array_sort(F.transform(entries, lambda e: F.struct(rank(e).alias("r"), e.alias("e")))),
            lambda s: s["e"],
        )
    line = lambda mark, text: F.concat(
        F.lit(f"{mark} "), byte_length(text, charset).cast("string"), F.lit("\n"), text, F.lit("\n")
    )
    body = F.transform(entries, lambda e: F.concat(line("K", e["key"]), line("V", e["value"])))
    return F.concat(F.array_join(body, ""), F.lit("PROPS-END"))


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\n"))


def record_bytes(content: Column, charset: str = "UTF-8", order: tuple[str, ...] = ()) -> Column:
    """Bytes of one record, from the columns of a node record and its resolved content."""
    c = F.col
    block = property_block(c("props"), charset, order)
    prop_len = byte_length(block, charset) + 1
    text_len = F.octet_length(content)
    name, kind, verb = _field("Node-path", c("path")), _field("Node-kind", c("node_kind")), _field(
        "Node-action", c("node_action")
    )
    prop_field = _field("Prop-content-length", prop_len)
    tail = F.concat(F.lit("\n"), block, F.lit("\n"))

    header = F.concat(
        _field("Revision-number", c("revision")), prop_field, _field("Content-length", prop_len),
        tail, F.lit("\n"),
    )
    directory = F.concat(
        name, kind, verb, prop_field, _field("Content-length", prop_len), tail, F.lit("\n")
    )
    delete = F.concat(name, verb, F.lit("\n"))
    copy = F.concat(
        name, kind, verb, _field("Node-copyfrom-rev", c("copy_from_rev")),
        _field("Node-copyfrom-path", c("copy_from_path")), F.lit("\n"),
    )
    text = F.concat(
        name, kind, verb, _field("Text-content-length", text_len),
        _field("Text-content-md5", F.md5(content)), prop_field,
        _field("Content-length", prop_len + text_len), tail,
    )
    plain = (
        F.when(c("part") == 0, header)
        .when(c("node_action") == "delete", delete)
        .when(c("copy_from_path").isNotNull(), copy)
        .when(c("node_kind") == "dir", directory)
    )
    return F.when(
        c("content_form").isNotNull(),
        F.concat(to_bytes(text, charset), content, to_bytes(F.lit("\n\n"), charset)),
    ).otherwise(to_bytes(plain, charset))
