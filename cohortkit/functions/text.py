"""Text predicates used to pick a cohort."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from cohortkit.constants import CODE_PREFIXES, DEATH_WORD, KEYWORDS, MISSING_TEXT

# Every character counted as blank when stripping a code.
_BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def _any(conditions: Sequence[Column]) -> Column:
    return F.coalesce(reduce(lambda a, b: a | b, conditions), F.lit(False))


def code_matches(
    code: Column, prefixes: Sequence[str] = CODE_PREFIXES, split_codes: bool = False
) -> Column:
    """True when the code, stripped and without dots, starts with a prefix.

    Only the head of the text is tested. ``split_codes`` tests each part of a
    comma-separated list instead. A missing code does not match.
    """

    def head(c: Column) -> Column:
        plain = F.replace(F.btrim(c, F.lit(_BLANKS)), F.lit("."), F.lit(""))
        return _any([plain.startswith(p) for p in prefixes])

    if split_codes:
        return F.coalesce(F.exists(F.split(code, ","), head), F.lit(False))
    return head(code)


def text_matches(
    text: Column, keywords: Sequence[str] = KEYWORDS, whole_word: bool = False
) -> Column:
    """True when the lower-cased text holds a keyword anywhere.

    ``whole_word`` asks for word boundaries around it.
    """
    lowered = F.lower(text)
    if whole_word:
        pattern = r"\b(" + "|".join(re.escape(k) for k in keywords) + r")\b"
        return F.coalesce(lowered.rlike(pattern), F.lit(False))
    return _any([lowered.contains(k) for k in keywords])


def died(status: Column, word: str = DEATH_WORD) -> Column:
    """1 when the status holds the word in any case, else 0; missing gives 0."""
    return F.coalesce(F.lower(status).contains(word), F.lit(False)).cast("int")


def joined_key(*parts: Column, separator: str = "_") -> Column:
    """Parts as text joined by a separator; a missing part reads ``nan``."""
    return F.concat_ws(
        separator, *[F.coalesce(p.cast("string"), F.lit(MISSING_TEXT)) for p in parts]
    )
