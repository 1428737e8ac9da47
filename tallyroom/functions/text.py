"""Text to terms: lower case, accent-free words and pairs of words."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: a word is two or more letters, digits or underscores.
WORD = r"[\p{L}\p{N}_]{2,}"


@lru_cache(1)
def _marks() -> re.Pattern:
    """All combining characters, as one class."""
    points = [p for p in range(0x110000) if unicodedata.combining(chr(p))]
    begins = [p for p in points if not unicodedata.combining(chr(p - 1))]
    ends = [p for p in points if p == 0x10FFFF or not unicodedata.combining(chr(p + 1))]
    return re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(begins, ends)) + "]+")


def _plain(run: str) -> str:
    return _marks().sub("", unicodedata.normalize("NFKD", run))


@lru_cache(1 << 14)
def _short_plain(run: str) -> str:
    return _plain(run)


_NOT_ASCII = re.compile(r"[^\x00-\x7F]+")


@F.pandas_udf(T.StringType())
def _without_marks(texts: pd.Series) -> pd.Series:
    """Only runs of non-ASCII characters are looked at: each is decomposed on its own, ASCII stays as it is."""
    replaced = lambda m: (_short_plain if len(m[0]) < 16 else _plain)(m[0])
    return texts.map(lambda text: _NOT_ASCII.sub(replaced, text), na_action="ignore")


def strip_accents(c: Column) -> Column:
    """Compatibility-decompose and drop combining marks.

    Spark has no such function, so texts with a non-ASCII character go
    through one Arrow batch call; pure ASCII texts are sent as NULL.
    """
    marked = F.when(c.rlike(r"[^\x00-\x7F]"), c)
    return F.coalesce(_without_marks(marked), c)


def words(c: Column) -> Column:
    return F.regexp_extract_all(strip_accents(F.lower(c)), F.lit(WORD), F.lit(0))


def _neighbours(word_list: Column, joined: Callable[[Column, Column], Column]) -> Column:
    n = F.greatest(F.size(word_list) - 1, F.lit(0))
    return F.zip_with(F.slice(word_list, F.lit(1), n), F.slice(word_list, F.lit(2), n), joined)


def with_pairs(word_list: Column) -> Column:
    """The words followed by each pair of neighbours joined by a space."""
    return F.concat(word_list, _neighbours(word_list, lambda left, right: F.concat_ws(" ", left, right)))


def some_pairs(word_list: Column, first: Sequence[str], second: Sequence[str] | None) -> Column:
    """Pairs of neighbours that begin and end with one of the given words (None: any word)."""

    def joined(left: Column, right: Column) -> Column:
        wanted = left.isin(*first) if second is None else left.isin(*first) & right.isin(*second)
        return F.when(wanted, F.concat_ws(" ", left, right))

    return F.array_compact(_neighbours(word_list, joined))


def is_pair(term: Column) -> Column:
    """A word holds no space."""
    return F.contains(term, F.lit(" "))


def term_marks(terms: Column) -> Column:
    """Every term of a document with (1, 0), then every distinct one with (0, 1).

    Summed over documents the first number is the total count, the second the
    number of documents.
    """

    def marks(array: Column, total: int, docs: int) -> Column:
        return F.transform(
            array,
            lambda t: F.struct(t.alias("term"), F.lit(total).alias("total"), F.lit(docs).alias("docs")),
        )

    return F.concat(marks(terms, 1, 0), marks(F.array_distinct(terms), 0, 1))
