"""Word tokenizer.

One regular expression without look-around, so that Java regex (Spark) and RE2 (the SQL oracle)
produce the same tokens. Words and numbers may carry inner apostrophes, dots, hyphens and digit
groups (``peer-reviewed``, ``3.14``, ``1,000``); an ellipsis and a double dash are single tokens; any
other non-space, non-letter, non-digit character is a token of its own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the tokenizer contract shared by the Spark code and the SQL oracle.
TOKEN_PATTERN = (
    r"[\p{L}\p{N}][\p{L}\p{M}\p{N}]*(?:['.\-][\p{L}\p{N}][\p{L}\p{M}\p{N}]*|,\p{N}[\p{L}\p{M}\p{N}]*)*"
    r"|\.\.\.|--|[^\s\x0B\p{Z}\p{L}\p{N}]"
)


def token_array(text: Column | str) -> Column:
    """``ARRAY<STRING>`` of the tokens of ``text`` in order (null text gives null)."""
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(col, F.lit(TOKEN_PATTERN), F.lit(0))


def sql_token_pattern() -> str:
    """The pattern as a SQL string literal body (single quotes doubled)."""
    return TOKEN_PATTERN.replace("'", "''")
