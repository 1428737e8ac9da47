"""Reject texts whose characters or common words are not those of a language.

Two histograms of a text are compared with those of each reference language by
Jensen-Shannon distance (base 2, square root of the divergence: 0 to 1): the
shares of character classes, and the shares of the language's commonest words
with one class for all others. A text passes if some reference is near in
both; how near depends on its length. References are the languages with at
least ``REFERENCE_WORDS`` words and, in small tables, those with 1 % of all
words; their counts cover all texts.

Guards: a text under ``min_words`` words fails, as does one in which more than
half of the words lie in repeated three-word windows. Null texts count as
empty. Rows without a language are judged all the same and give no reference.
Repeated rows repeat their result. Whole texts are read, in pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.llm.words import word_hashes
from tallyroom.sources.durable import durable

MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
COMMON = 100  # words of a language's histogram
REFERENCE_WORDS = 10_000  # words of a language, to be a reference
MIN_SHARE = 0.01  # or share of all words
#: Distance (base, slack) up to which a text of n words counts as near: base + slack / sqrt(n),
#: since the histogram of a short text strays from its language's by chance.
MAX_CHARS = (0.12, 1.0)
MAX_WORDS = (0.20, 2.4)

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_BLANKS = re.compile(r"[\x20\x09-\x0D]")
_SYMBOL = re.compile("[" + re.escape(SYMBOLS) + "]")
#: Byte classes: 0 lower case, 1 upper case, 2 digit, 3 sentence marks, 4 symbols, 5 white space, 6 control; letters beyond ASCII count as lower.
N_CLASSES = 7
_CLASS = np.full(256, 4, dtype=np.int64)
_CLASS[97:123] = 0
_CLASS[128:] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 5
_CLASS[[*range(9), *range(14, 32), 127]] = 6


def char_classes(text: str | None) -> np.ndarray:
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    raw = raw[(raw & 0xC0) != 0x80]  # one byte a character
    return np.bincount(_CLASS[raw], minlength=N_CLASSES)


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two count vectors; 1 if either is empty."""
    if not p.sum() or not q.sum():
        return 1.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(0.0, d / 2)))


@dataclass(frozen=True)
class Reference:
    """Histograms of one language: character classes, common words (sorted hashes), their counts and that of all others."""

    lang: str
    chars: np.ndarray
    words: np.ndarray
    counts: np.ndarray

    def distances(self, chars: np.ndarray, words: np.ndarray) -> tuple[float, float]:
        at = np.minimum(np.searchsorted(self.words, words), max(0, len(self.words) - 1))
        known = self.words[at] == words if len(self.words) else np.zeros(len(words), bool)
        own = np.bincount(at[known], minlength=len(self.words))
        return js_distance(chars, self.chars), js_distance(np.append(own, len(words) - known.sum()), self.counts)


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", common: int = COMMON) -> list[Reference]:
    """Histograms of the languages that hold ``REFERENCE_WORDS`` words or ``MIN_SHARE`` of all."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, texts in pdf.groupby("lang")["text"]:
                hashes, _ = word_hashes(texts.tolist())
                found, n = np.unique(hashes, return_counts=True)
                yield pd.DataFrame({"lang": lang, "kind": "word", "item": found.view(np.int64), "n": n})
                classes = sum((char_classes(t) for t in texts), np.zeros(N_CLASSES, dtype=np.int64))
                yield pd.DataFrame({"lang": lang, "kind": "char", "item": np.arange(N_CLASSES), "n": classes})

    counts = durable(
        docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull())
        .mapInPandas(count, "lang string, kind string, item bigint, n bigint")
        .groupBy("lang", "kind", "item")
        .agg(F.sum("n").alias("n")),
        "quality-counts",
    )
    words = counts.where(F.col("kind") == "word").groupBy("lang").agg(F.sum("n").alias("total"))
    share = F.col("total") / F.sum("total").over(Window.partitionBy())  # one row per language
    large = words.withColumn("share", share).where((F.col("total") >= REFERENCE_WORDS) | (F.col("share") >= MIN_SHARE)).select("lang", "total").collect()  # one row per language
    if not large:
        return []
    total = {r.lang: r.total for r in large}
    top = Window.partitionBy("lang").orderBy(F.col("n").desc(), "item")
    kept = counts.where(F.col("lang").isin(list(total)))
    commonest = kept.where(F.col("kind") == "word").withColumn("at", F.row_number().over(top)).where(F.col("at") <= common)
    by_lang: dict[str, dict[str, list]] = {lang: {"word": [], "char": []} for lang in total}
    for r in commonest.drop("at").unionByName(kept.where(F.col("kind") == "char")).collect():  # 107 rows a language
        by_lang[r.lang][r.kind].append((r["item"], r["n"]))
    out = []
    for lang in sorted(total):
        items = sorted((np.int64(i).astype(np.uint64), n) for i, n in by_lang[lang]["word"])
        counted = np.array([n for _, n in items], dtype=np.int64)
        chars = np.zeros(N_CLASSES, dtype=np.int64)
        for i, n in by_lang[lang]["char"]:
            chars[i] = n
        out.append(
            Reference(lang, chars, np.array([i for i, _ in items], dtype=np.uint64), np.append(counted, total[lang] - counted.sum()))
        )
    return out


def repeated_window_words(hashes: np.ndarray, width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found at least twice."""
    n = len(hashes) - width + 1
    if n < 2:
        return 0
    h = hashes[:n].copy()
    for j in range(1, width):
        h = h * np.uint64(0xD6E8FEB86659FD93) + hashes[j : n + j]
    _, inverse, times = np.unique(h, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[inverse] > 1)
    edge = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return int((np.cumsum(edge) > 0).sum())


def measures(text: str | None) -> tuple[int, int, int]:
    """Code points in words, symbols, repeated lines."""
    text = text or ""
    seen: set[str] = set()
    repeated = 0
    for line in text.split("\n"):
        if line in seen:
            repeated += 1
        elif _WORDS.search(line):
            seen.add(line)
    return len(text) - len(_BLANKS.findall(text)), len(_SYMBOL.findall(text)), repeated


def judge(
    docs: DataFrame,
    refs: list[Reference],
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    max_chars: tuple[float, float] = MAX_CHARS,
    max_words: tuple[float, float] = MAX_WORDS,
) -> DataFrame:
    """One row per document with its measures, nearest reference, distances and ``kept``."""
    fields = (
        "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "base_failed boolean, kept boolean, nearest_lang string, char_distance double, word_distance double"
    )
    names = [x.split()[0] for x in fields.split(", ")]

    @F.pandas_udf(fields)
    def rate(series: pd.Series) -> pd.DataFrame:
        texts = series.tolist()
        exact, counts = word_hashes(texts, fold=False)
        folded, _ = word_hashes(texts)
        rows, at = [], 0
        for text, n in zip(texts, counts):
            again = repeated_window_words(exact[at : at + n])
            failed = bool(n < min_words or 100 * again > 50 * n)
            classes = char_classes(text)
            allowed = [base + slack / max(n, 1) ** 0.5 for base, slack in (max_chars, max_words)]
            near = sorted(
                (max(c / allowed[0], w / allowed[1]), r.lang, c, w)
                for r in refs
                for c, w in [r.distances(classes, folded[at : at + n])]
            )[:1]
            best, lang, c, w = near[0] if near else (0.0, None, None, None)
            rows.append((n, *measures(text), again, failed, not failed and best <= 1.0, lang, c, w))
            at += n
        return pd.DataFrame(rows, columns=names)

    rated = docs.select(F.col(id_col), rate(F.col(text_col)).alias("_rated"))
    return rated.select(id_col, *[F.col(f"_rated.{c}") for c in names])
