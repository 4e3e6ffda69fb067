"""Token normalization.

A technique maps a token column to a new value or drops the row. The pipeline applies techniques in
order; dropping filters are applied as early as they come so later (costlier) techniques, such as the
stemmer, only see surviving tokens. Filters on plain columns are pushed below projections by Catalyst.

Users may add their own technique: ``Technique.from_column(name, fn)`` where ``fn`` maps a column to
a new value, ``null`` meaning "drop the token".
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.porter import porter_stem
from quarry.functions.stopwords import FIRST_STOP_WORDS, REST_STOP_WORDS

# Fixed value: a token made only of digits, dots and commas is a number (and dropped).
NUMBER_PATTERN = "^[0-9.,]+$"


@dataclass(frozen=True)
class Technique:
    """A normalization step. ``apply(df, col, guard)`` returns ``df`` with ``col`` normalized; rows
    where the boolean column ``guard`` is true pass through untouched (they carry markers, not
    tokens). Frame-level techniques (the stemmer) must keep null values as null rows."""
    name: str
    apply_fn: Callable[[DataFrame, str, Column | None], DataFrame]

    def apply(self, df: DataFrame, col: str, guard: Column | None = None) -> DataFrame:
        return self.apply_fn(df, col, guard)

    @staticmethod
    def from_column(name: str, fn: Callable[[Column], Column]) -> "Technique":
        """Map the token to ``fn(token)``; a null result drops the token."""
        def _apply(df: DataFrame, col: str, guard: Column | None) -> DataFrame:
            value = fn(F.col(col))
            if guard is None:
                return df.withColumn(col, value).filter(F.col(col).isNotNull())
            return (df.withColumn(col, F.when(guard, F.col(col)).otherwise(value))
                    .filter(F.col(col).isNotNull() | guard))
        return Technique(name, _apply)

    @staticmethod
    def keep_if(name: str, predicate: Callable[[Column], Column]) -> "Technique":
        """Keep the tokens for which ``predicate`` holds."""
        def _apply(df: DataFrame, col: str, guard: Column | None) -> DataFrame:
            cond = predicate(F.col(col))
            return df.filter(cond if guard is None else (cond | guard))
        return Technique(name, _apply)

    @staticmethod
    def map_column(name: str, fn: Callable[[Column], Column]) -> "Technique":
        """Replace the token by ``fn(token)`` (never drops)."""
        def _apply(df: DataFrame, col: str, guard: Column | None) -> DataFrame:
            value = fn(F.col(col))
            return df.withColumn(col, value if guard is None else F.when(guard, F.col(col)).otherwise(value))
        return Technique(name, _apply)

    @staticmethod
    def frame(name: str, fn: Callable[[DataFrame, str], DataFrame]) -> "Technique":
        """A technique over the whole frame (null values must stay null rows)."""
        return Technique(name, lambda df, col, guard: fn(df, col))


UNFILTERED = Technique.frame("Unfiltered", lambda df, col: df)
REMOVE_NUMBERS = Technique.keep_if("RemoveNumbers", lambda c: ~c.rlike(NUMBER_PATTERN))
CASEFOLDING = Technique.map_column("Casefolding", F.lower)
FIRST_STOP_WORDS_FILTER = Technique.keep_if("ThirtyStopWords", lambda c: ~c.isin(FIRST_STOP_WORDS))
REST_STOP_WORDS_FILTER = Technique.keep_if("OneHundredFiftyStopWords", lambda c: ~c.isin(REST_STOP_WORDS))
PORTER_STEMMING = Technique.frame("PorterStemming", lambda df, col: porter_stem(df, col))

ALL_TECHNIQUES: tuple[Technique, ...] = (
    UNFILTERED, REMOVE_NUMBERS, CASEFOLDING, FIRST_STOP_WORDS_FILTER, REST_STOP_WORDS_FILTER,
    PORTER_STEMMING,
)
NO_STEM_TECHNIQUES: tuple[Technique, ...] = ALL_TECHNIQUES[:-1]


def technique_names(techniques: Sequence[Technique] = ALL_TECHNIQUES) -> list[str]:
    return [t.name for t in techniques]


def normalize(df: DataFrame, col: str = "token", out: str = "term",
              techniques: Sequence[Technique] | Technique = ALL_TECHNIQUES,
              marker: str | None = None) -> DataFrame:
    """Normalize the tokens of ``df[col]`` into ``out``; rows whose token is dropped disappear.

    ``techniques`` is a sequence, or a single technique (wrapped into a one-element list).
    ``marker`` names a boolean column; rows where it is true pass every technique untouched.
    """
    if isinstance(techniques, Technique):
        techniques = [techniques]
    guard = F.col(marker) if marker else None
    cur = df.withColumn(out, F.col(col)) if out != col else df
    cur = cur.filter(F.col(out).isNotNull() if guard is None else (F.col(out).isNotNull() | guard))
    for t in techniques:
        cur = t.apply(cur, out, guard)
    return cur
