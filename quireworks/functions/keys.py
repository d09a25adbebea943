"""Hashes, titles, file-name parts and the metadata object, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quireworks.functions.text import strip_whitespace

# The defaults for a missing title.
UNTITLED = "Untitled"
UNKNOWN = "Unknown"
UNTITLED_PREFIX = "untitled_"


def content_hash(text: Column) -> Column:
    """Lower-hex SHA-256 of the UTF-8 text; the title takes no part."""
    return F.sha2(text, 256)


def title_content_hash(title: Column, text: Column) -> Column:
    """Hash over title and text, both stripped and lower-cased; null counts as empty."""
    parts = [F.lower(strip_whitespace(F.coalesce(c, F.lit("")))) for c in (title, text)]
    return F.sha2(F.concat_ws("::", *parts), 256)


def hash_prefix(hash_: Column) -> Column:
    return F.concat(F.substring(hash_, 1, 8), F.lit("..."))


def title_or_content_id(title: Column, content: Column) -> Column:
    """The title, or one made from the content where it is null."""
    made = F.concat(F.lit(UNTITLED_PREFIX), content_hash(F.coalesce(content, F.lit(""))))
    return F.coalesce(title, made)


def chunk_id(title: Column, chunk_idx: Column) -> Column:
    return F.concat(title, F.lit("_"), chunk_idx.cast("string"))


def metadata_json(title: Column, hash_: Column | None = None) -> Column:
    fields = [title.alias("title")]
    if hash_ is not None:
        fields.append(hash_.alias("content_hash"))
    return F.to_json(F.struct(*fields))


def metadata_field(metadata: Column, name: str) -> Column:
    return F.get_json_object(metadata, f"$.{name}")


def hit_title(metadata: Column) -> Column:
    return F.coalesce(metadata_field(metadata, "title"), F.lit(UNKNOWN))


def row_uuid(*parts: Column) -> Column:
    """Deterministic row key, so a rerun of the same input writes the same keys."""
    return F.sha2(F.concat_ws("\u0001", *[p.cast("string") for p in parts]), 256)


def path_scheme_removed(path: Column) -> Column:
    return F.regexp_replace(path, "^s3[an]?://", "")


def path_bucket(path: Column) -> Column:
    return F.substring_index(path_scheme_removed(path), "/", 1)


def path_key(path: Column) -> Column:
    """Everything after the first slash; empty for a bare bucket."""
    return F.regexp_extract(path_scheme_removed(path), r"(?s)^[^/]*/(.*)$", 1)


def path_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def path_stem(path: Column) -> Column:
    """File name without its last suffix; a leading dot starts no suffix."""
    return F.regexp_extract(path_name(path), r"(?s)^(\.*.+?)(\.[^.]*)?$", 1)


def has_suffix(path: Column, suffix: str, case_sensitive: bool = False) -> Column:
    if case_sensitive:
        return F.endswith(path, F.lit(suffix))
    return F.endswith(F.lower(path), F.lit(suffix.lower()))
