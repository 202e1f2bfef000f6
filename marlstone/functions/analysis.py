"""How texts become search terms: one analyser, named in every index, for documents, queries and filter values alike."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .text import ARABIC_FORMS, ARABIC_MARKS

_WORD = re.compile(r"[^\W_]{2,}")
_MARKS = re.compile(ARABIC_MARKS)
_FORMS = str.maketrans(*ARABIC_FORMS)


def _bare(text: str) -> str:
    """The text without combining marks."""
    for mark in filter(unicodedata.combining, set(text)):
        text = text.replace(mark, "")
    return text


def search_form(text: str) -> str:
    """Case, accents and compatibility forms folded; Arabic marks dropped, letter variants joined."""
    if text.isascii():
        return text.lower()
    plain = _MARKS.sub("", unicodedata.normalize("NFKC", text).casefold())
    if any(form in plain for form in ARABIC_FORMS[0]):
        plain = plain.translate(_FORMS)
    return _bare(unicodedata.normalize("NFKD", plain))


@F.pandas_udf(StringType())
def folded_form(values: pd.Series) -> pd.Series:
    """The trimmed search form of each value."""
    return values.map(lambda v: None if v is None else search_form(v).strip())


@F.pandas_udf(ArrayType(StringType()))
def fold_array(values: pd.Series) -> pd.Series:
    """The trimmed search forms of arrays of values."""
    return values.map(lambda each: None if each is None else [search_form(v).strip() for v in each])


class FoldedWords:
    """Runs of letters and digits of the search form, two characters at least."""

    name = "folded-words-1"

    def __call__(self, text: str | None) -> list[str]:
        return _WORD.findall(search_form(text)) if text else []


#: Analysers by the name that an index keeps.
ANALYSERS = {FoldedWords.name: FoldedWords}
