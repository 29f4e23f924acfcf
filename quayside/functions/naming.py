"""Argument rules: sizes, output file names, table names, file formats."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

_HELPERS = uuid.uuid4().hex[:12]

# Size units are base 10.
SIZE_UNITS = {"": 1, "KB": 1_000, "MB": 1_000_000, "GB": 1_000_000_000}
# Fixed value: the largest size the 64-bit unsigned counter can hold.
MAX_SIZE = 2**64 - 1
# The file formats that can be loaded.
FORMATS = ("parquet", "csv")


def helper_name(name: str) -> str:
    """A column name for internal use, drawn anew in each process, that no user column has."""
    return f"__{name}_{_HELPERS}"


def parse_size(text: str) -> int:
    """``500KB`` -> 500000; a bare number is bytes; the unit's case does not matter."""
    if not text.strip():
        raise ValueError("size string is empty")
    match = re.fullmatch(r"\s*\+?([0-9]+)\s*(KB|MB|GB|)\s*", text, flags=re.IGNORECASE | re.ASCII)
    if match is None:
        raise ValueError(f"invalid size: '{text.strip()}'")
    size = int(match[1]) * SIZE_UNITS[match[2].upper()]
    if size > MAX_SIZE:
        raise ValueError(f"size overflow: '{text.strip()}'")
    return size


def split_base(path: str) -> tuple[str, str, str]:
    """(directory with trailing slash, stem, extension with dot) of an output path."""
    directory, slash, name = path.rpartition("/")
    stem, dot, extension = name.rpartition(".")
    if not stem:  # no dot, or a name such as ".hidden"
        stem, dot, extension = name, "", ""
    return directory + slash, stem, dot + extension if extension else ""


def split_file_path(path: str, index: int) -> str:
    """The ``index``-th part of ``dir/data.csv`` is ``dir/data_000.csv`` and so on."""
    directory, stem, extension = split_base(path)
    return f"{directory}{stem}_{index:03d}{extension}"


def split_file_name(path: str, index: Column) -> Column:
    """Column form of :func:`split_file_path`, without the directory."""
    _, stem, extension = split_base(path)
    literal = (stem.replace("%", "%%"), extension.replace("%", "%%"))
    return F.format_string(f"{literal[0]}_%03d{literal[1]}", index)


def quote_identifier(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def table_identifier(name: str) -> str:
    """Quote each part of ``table`` or ``schema.table``; text with backticks is kept."""
    if "`" in name:
        return name
    return ".".join(quote_identifier(part) for part in name.split("."))


def detect_format(path: str) -> str:
    """File format by extension, in any case."""
    extension = split_base(path)[2][1:].lower()
    if extension not in FORMATS:
        raise ValueError(
            f"unsupported file format: '{extension}' in {path}; supported: .parquet, .csv"
        )
    return extension


def format_of(path: Column) -> Column:
    """Column form of :func:`detect_format`: the format, or NULL when unsupported."""
    name = F.substring_index(path, "/", -1)
    extension = F.lower(F.regexp_extract(name, r"^.+\.([^.]*)$", 1))
    return F.when(extension.isin(*FORMATS), extension)
