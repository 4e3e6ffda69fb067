"""Column-level building blocks: tokenizer, normalization techniques, Porter stemmer."""

from quarry.functions.tokenize import TOKEN_PATTERN, token_array
from quarry.functions.normalize import (
    Technique, UNFILTERED, REMOVE_NUMBERS, CASEFOLDING, FIRST_STOP_WORDS_FILTER,
    REST_STOP_WORDS_FILTER, PORTER_STEMMING, ALL_TECHNIQUES, NO_STEM_TECHNIQUES,
    normalize, technique_names,
)
from quarry.functions.porter import porter_stem

__all__ = [
    "TOKEN_PATTERN", "token_array", "Technique", "UNFILTERED", "REMOVE_NUMBERS", "CASEFOLDING",
    "FIRST_STOP_WORDS_FILTER", "REST_STOP_WORDS_FILTER", "PORTER_STEMMING", "ALL_TECHNIQUES",
    "NO_STEM_TECHNIQUES", "normalize", "technique_names", "porter_stem",
]
