"""Column functions over object paths."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from runweave.schemas import DEFAULT_CONTENT_TYPE


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_path(col: str | Column) -> Column:
    """Without dots and slashes at both ends."""
    return F.trim(_c(col), F.lit("./"))


def strip_slashes(col: str | Column) -> Column:
    return F.trim(_c(col), F.lit("/"))


def extension(col: str | Column) -> Column:
    """Last extension in lower case with its dot; empty when the file name has none."""
    name = F.regexp_extract(_c(col), r"([^/]*)\z", 1)
    # Leading dots belong to the name, not to an extension.
    return F.lower(F.regexp_extract(name, r"^\.*[^.].*?(\.[^.]*)\z", 1))


def content_type(col: str | Column, mime_types: Mapping[str, str]) -> Column:
    """MIME type by extension, from a small extension table."""
    if not mime_types:
        return F.lit(DEFAULT_CONTENT_TYPE)
    lookup = F.create_map(*[F.lit(x) for pair in mime_types.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, extension(col)), F.lit(DEFAULT_CONTENT_TYPE))


def path_join(*parts: str | Column) -> Column:
    """Parts joined by one slash; an absolute part starts over, as file systems read it."""
    out = _c(parts[0])
    for part in parts[1:]:
        part = _c(part)
        joined = F.when(
            out.endswith("/") | (out == ""), F.concat(out, part)
        ).otherwise(F.concat(out, F.lit("/"), part))
        out = F.when(part.startswith("/"), part).otherwise(joined)
    return out


def parent_folder(col: str | Column) -> Column:
    """Folder part of a path, without the final slash."""
    head = F.regexp_extract(_c(col), r"(?s)^(.*/)[^/]*\z", 1)
    bare = F.rtrim(head, F.lit("/"))
    return F.when((bare == "") & (head != ""), head).otherwise(bare)


def ancestor_folders(col: str | Column) -> Column:
    """The path and every folder above it: ``a/b/c`` gives ``a``, ``a/b``, ``a/b/c``."""
    parts = F.split(F.rtrim(_c(col), F.lit("/")), "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")
    )
