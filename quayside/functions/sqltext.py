"""SQL-text functions over columns: split scripts, strip comments, classify, shorten, hint.

Quotes and comments are skipped with possessive regular expressions, which Java
runs as plain loops: each function is one pass over the text inside the JVM, and
neither long scripts nor long literals cost stack or backtracking.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the Unicode white space characters.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Statement kind by first word; any other word, or none, is Ddl.
QUERY_WORDS = ("SELECT", "WITH", "DESCRIBE", "EXPLAIN", "SHOW")
DML_WORDS = ("INSERT", "UPDATE", "DELETE", "MERGE")
EXECUTE_WORDS = ("EXECUTE",)
# Fixed value: longest text shown in a status line, in bytes.
DISPLAY_LENGTH = 60
# Advice per kind of error message, first match wins.
HINT_OBJECT = "Check that the table exists and the schema is correct."
HINT_PERMISSION = "The user may not have the required permissions."
HINT_SYNTAX = "Check your SQL syntax near the marked position."
HINT_CONNECTION = "Check the connection string and ensure the database is reachable."

_SPACE = f"[{WHITE_SPACE}]"
# Unterminated quotes and block comments run to the end of the text.
_QUOTED = r"""'[^']*+(?:'|\z)|"[^"]*+(?:"|\z)"""
_COMMENT = r"--[^\n]*+|/\*[\s\S]*?(?:\*/|\z)"
# Everything up to a semicolon that is neither quoted nor in a comment.
_PIECE = rf"""(?:{_QUOTED}|{_COMMENT}|[^;'"/-]++|[-/])++"""
_BLANK = rf"\A(?:{_SPACE}++|{_COMMENT})*+\z"
# Code and then a comment, from where the last match ended.
_COMMENTED = rf"""\G((?:{_QUOTED}|[^'"/-]++|-(?!-)|/(?!\*))*+)(?:{_COMMENT})"""
# A word without quotes, up to white space, a comment or the end.
_FIRST_WORD = rf"""\A(?:{_SPACE}++|{_COMMENT})*+([^{WHITE_SPACE}'"/-]++)(?={_SPACE}|--|/\*|\z)"""


def trim_space(text: Column) -> Column:
    return F.trim(text, F.lit(WHITE_SPACE))


def strip_comments(text: Column) -> Column:
    """Replace each comment by one space; quoted text is kept."""
    return F.regexp_replace(text, _COMMENTED, "$1 ")


def split_statements(script: Column) -> Column:
    """Array of the statements of a script, trimmed, comments kept.

    Semicolons inside quotes and comments do not cut.  Pieces with nothing but
    white space and comments are dropped.
    """
    pieces = F.regexp_extract_all(script, F.lit(_PIECE), F.lit(0))
    statements = F.filter(pieces, lambda piece: ~piece.rlike(_BLANK))
    return F.transform(statements, trim_space)


def first_word(sql: Column) -> Column:
    """First word of a statement after its comments, in upper case.

    Empty if there is none, or if quotes or operators are part of it.
    """
    return F.upper(F.regexp_extract(sql, _FIRST_WORD, 1))


def classify(sql: Column) -> Column:
    """``Query``, ``Dml``, ``Execute`` or ``Ddl``, from the first word."""
    kinds = {"Query": QUERY_WORDS, "Dml": DML_WORDS, "Execute": EXECUTE_WORDS}
    by_word = [F.lit(x) for kind, words in kinds.items() for word in words for x in (word, kind)]
    # A lookup, so that the word is searched for once and not once per kind.
    return F.coalesce(F.try_element_at(F.create_map(*by_word), first_word(sql)), F.lit("Ddl"))


def truncate_sql(sql: Column, max_length: int = DISPLAY_LENGTH) -> Column:
    """Trimmed text; beyond ``max_length`` bytes, its first characters and ``...``."""
    text = trim_space(sql)
    short = F.concat(F.substring(text, 1, max_length - 3), F.lit("..."))
    return F.when(F.octet_length(text) > max_length, short).otherwise(text)


def error_hint(message: Column) -> Column:
    """Advice for an error message, or NULL."""
    text = F.lower(message)
    return (
        F.when(text.contains("object") & text.contains("not found"), HINT_OBJECT)
        .when(
            text.contains("insufficient privileges") | text.contains("not allowed"),
            HINT_PERMISSION,
        )
        .when(text.contains("syntax error"), HINT_SYNTAX)
        .when(text.contains("connect"), HINT_CONNECTION)
    )
