"""CSV dialect shared by readers, writers, schema inference and size estimates."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.naming import quote_identifier

# Microsecond time text, so a round trip loses nothing.
TIME_TEXT = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


@dataclass(frozen=True)
class CsvDialect:
    """Field format of a CSV file.

    ``escape=None`` means RFC 4180 doubling of the quote.  ``multi_line`` lets a
    quoted field hold line breaks, and then files are not split at every line; by
    default that is so for the files that turn out to have some.
    """

    delimiter: str = ","
    quote: str = '"'
    escape: str | None = None
    header: bool = True
    null_value: str = ""
    multi_line: bool | None = None

    def __post_init__(self) -> None:
        for label in ("delimiter", "quote"):
            if len(getattr(self, label)) != 1:
                raise ValueError(f"{label} must be one character")
        if self.escape is not None and len(self.escape) != 1:
            raise ValueError("escape must be one character")
        if self.delimiter == self.quote:
            raise ValueError("delimiter and quote must differ")

    def _fields(self) -> dict[str, str]:
        # A doubled quote needs no escape of its own; left unset, Spark takes NUL for it.
        doubling = {} if self.escape else {"charToEscapeQuoteEscaping": self.quote}
        return doubling | {
            "sep": self.delimiter,
            "quote": self.quote,
            "escape": self.escape or self.quote,
            "nullValue": self.null_value,
            "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false",
        }

    def read_options(self) -> dict[str, str]:
        return self._fields() | {
            "header": str(self.header).lower(),
            "multiLine": str(self.multi_line is not False).lower(),
            "mode": "FAILFAST",
            "enforceSchema": "false",
            "maxCharsPerColumn": "-1",
        }

    def whole_line_pattern(self) -> str:
        """Regular expression of a line that holds a whole record, without doubt."""
        delimiter, quote = re.escape(self.delimiter), re.escape(self.quote)
        if self.escape in (None, self.quote):
            inside = rf"[^{quote}]++|{quote}{quote}"
        else:
            escape = re.escape(self.escape)
            inside = rf"[^{quote}{escape}]++|{escape}."
        field = rf"(?:{quote}(?:{inside})*+{quote}|[^{delimiter}{quote}]*+)"
        return rf"\A{field}(?:{delimiter}{field})*+\z"

    def text_options(self) -> dict[str, str]:
        """Options that shape one written line; also valid for ``to_csv``."""
        return self._fields() | TIME_TEXT

    def line_columns(self, schema: T.StructType) -> list[Column]:
        """The columns to write so that each row gets a line.

        A row whose only field is an empty NULL would be an empty line, which
        Spark leaves out; written as quoted empty text it still reads as NULL.
        """
        columns = [F.col(quote_identifier(name)) for name in schema.names]
        if len(columns) != 1 or self.null_value:
            return columns
        field = schema.fields[0]
        if isinstance(field.dataType, T.TimestampNTZType):
            text = F.date_format(columns[0], TIME_TEXT["timestampNTZFormat"])
        elif isinstance(field.dataType, T.TimestampType):
            text = F.date_format(columns[0], TIME_TEXT["timestampFormat"])
        else:
            text = columns[0].cast("string")
        return [F.coalesce(text, F.lit("")).alias(field.name)]

    def write_options(self) -> dict[str, str]:
        return self.text_options() | {"header": str(self.header).lower(), "lineSep": "\n"}
