"""Language of a text by string kernels, landmarks and ridge regression.

The kernel of two texts is the number of character n-grams (``GRAMS`` long,
blended) that occur in both, divided by the root of the product of how many
each has: presence, not counts, so a repeated line weighs nothing extra.
Letters are lower-cased, marks stay, every other character counts as a space.
An n-gram is represented by ``BITS`` bits of its hash.

Nyström: some texts of each language are landmarks, and a text x is described
by its kernels with them, k(x), turned by the root of the landmarks' own
kernel matrix: z(x) = k(x) K^-1/2. One ridge regression for each language
against the rest (1 and -1) is fitted on z. What it needs of the training
texts are the sums of k k' and of k y, which tasks add up; the driver gets one
matrix of landmarks by landmarks from each of ``TASKS`` tasks, whatever the
length of the texts. Since a kernel is a sum over n-grams, landmarks,
K^-1/2 and the coefficients multiply into one matrix of n-grams by languages;
texts are scored by batches, as presence matrix times that matrix.

Bounds, all parameters: at most ``rows`` different training texts, as many of
each language, those with the smallest hashes; at most ``landmarks`` of them,
of at most ``landmark_bytes``. A language gets ``LEAST_ROWS`` texts and
``LEAST_LANDMARKS`` landmarks however many languages there are. N-grams that
no landmark has count nowhere. Every text is scored, and read whole.

``und`` with score 0 stands for null texts, texts without a letter, and all
texts if there is nothing to learn from. A text whose n-grams are all unknown
gets the language with the most training texts, as do equal scores (then the
smaller name). Equal texts, ids of any kind and repeated rows make no
difference; equal training texts of two languages count for each. Rows keep
all their columns, whatever their names.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.llm.words import U64, mix
from tallyroom.sources.durable import durable, small_frame

GRAMS = (1, 2, 3, 4)
BITS = 22
ROWS, LEAST_ROWS = 4096, 64
LANDMARKS, LEAST_LANDMARKS, LANDMARK_BYTES = 256, 4, 20_000
RIDGE = 1e-3  # times the number of training texts
SHARPNESS = 4.0  # of the share that a language's score takes
TASKS = 16
UNKNOWN = "und"

_PIECE = 1 << 20  # characters looked at together
_CELLS = 1 << 24  # of a presence matrix
_STEP = U64(0x9E3779B97F4A7C15)


@lru_cache(1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: what it counts as, and whether it is a letter."""
    folded, letter = np.full(0x110000, 32, dtype=np.uint64), np.zeros(0x110000, dtype=bool)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            lower = char.lower()
            folded[point], letter[point] = ord(lower) if len(lower) == 1 else point, True
        elif unicodedata.category(char)[0] == "M":
            folded[point] = point
    return folded, letter


def grams(text: str) -> Iterator[np.ndarray]:
    """Codes of the n-grams of `` text ``, not distinct, piece by piece."""
    folded, _ = _characters()
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    for at in range(0, len(points), _PIECE):
        piece = folded[points[at : at + _PIECE + max(GRAMS) - 1]]
        code = piece
        for n in range(1, max(GRAMS) + 1):
            if n > 1:
                code = code[:-1] * _STEP + piece[n - 1 :]
            if not len(code):
                break
            if n in GRAMS:
                yield (mix(code * _STEP + U64(n)) >> U64(64 - BITS)).astype(np.int64)


def has_letter(text: str | None) -> bool:
    if not text:
        return False
    _, letter = _characters()
    return bool(letter[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)].any())


def presence(text: str) -> np.ndarray:
    """Distinct codes of a text, sorted."""
    return np.unique(np.concatenate([np.unique(codes) for codes in grams(text)]))


class Landmarks:
    """Texts that others are compared with: which of them has an n-gram."""

    def __init__(self, texts: list[str]):
        sets = [presence(t) for t in texts]
        self.sizes = np.array([len(s) for s in sets], dtype=np.float64)
        codes = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(codes, kind="stable")
        #: Known codes, sorted; those of place v are had by the landmarks owners[begin[v]:begin[v + 1]].
        self.codes, first = np.unique(codes[order], return_index=True)
        self.begin = np.append(first, len(codes))
        self.owners = owner[order]

    def kernel(self, text: str) -> np.ndarray:
        """Kernels of a text with each landmark."""
        own = presence(text)
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        at = at[self.codes[at] == own]
        counts = self.begin[at + 1] - self.begin[at]
        before = np.cumsum(counts) - counts
        shared = np.bincount(self.owners[np.repeat(self.begin[at] - before, counts) + np.arange(counts.sum())], minlength=len(self.sizes))
        return shared / np.sqrt(max(1, len(at)) * self.sizes)


@dataclass(frozen=True)
class Model:
    """Languages, known n-gram codes (sorted) and the weight of each for each language."""

    langs: list[str]
    codes: np.ndarray
    weights: np.ndarray

    @cached_property
    def place(self) -> np.ndarray:
        """Row of a code in ``weights``; unknown ones share the one past the end."""
        place = np.full(1 << BITS, len(self.codes), dtype=np.int32)
        place[self.codes] = np.arange(len(self.codes))
        return place

    def margins(self, texts: list[str]) -> np.ndarray:
        """Regression value of each language, a row for each text."""
        known = len(self.codes)
        out = np.zeros((len(texts), len(self.langs)))
        step = max(1, _CELLS // (known + 1))
        for at in range(0, len(texts), step):
            some = texts[at : at + step]
            present = np.zeros((len(some), known + 1), dtype=np.float32)
            for row, text in zip(present, some):
                for codes in grams(text):
                    row[self.place[codes]] = 1
            present = present[:, :known]
            size = present.sum(axis=1, keepdims=True)
            out[at : at + step] = (present @ self.weights) / np.sqrt(np.maximum(size, 1))
        return out

    def classify(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        told = [i for i, t in enumerate(texts) if self.langs and has_letter(t)]
        if told:
            margins = self.margins([texts[i] for i in told])
            share = np.exp(SHARPNESS * (margins - margins.max(axis=1, keepdims=True)))
            scores[told] = 1 / share.sum(axis=1)
            for i, best in zip(told, margins.argmax(axis=1)):
                langs[i] = self.langs[best]
        return langs, scores


def fit(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang", rows: int = ROWS, landmarks: int = LANDMARKS, landmark_bytes: int = LANDMARK_BYTES) -> Model:
    """Model of the languages of the rows for which ``train`` holds."""
    spark = docs.sparkSession
    text, lang = F.col(text_col), F.col(lang_col)
    labelled = docs.where(train & text.isNotNull() & lang.isNotNull() & text.rlike(r"\p{L}")).select(lang.alias("lang"), text.alias("text"), F.xxhash64(text).alias("code"))
    # Copies of a text meet before the shuffle; then the smallest hashes of each language.
    different = durable(labelled.groupBy("lang", "code").agg(F.count(F.lit(1)).alias("n")), "language-texts")
    found = different.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts")).collect()  # one row per language
    sizes = {r.lang: r.n for r in found}
    if not sizes:
        return Model([], np.empty(0, dtype=np.int64), np.empty((0, 0), dtype=np.float32))
    langs = sorted(sizes, key=lambda x: (-sizes[x], x))
    each = max(LEAST_ROWS, rows // len(langs))
    by_code = Window.partitionBy("lang").orderBy("code")
    # Hashes are spread evenly: the smallest of a language lie below twice their share of the whole range.
    limits = [(r.lang, min((1 << 63) - 1, -(1 << 63) + (2 * each << 64) // r.texts)) for r in found]
    low = different.join(F.broadcast(small_frame(spark, limits, "lang string, code_limit bigint")), "lang").where(F.col("code") <= F.col("code_limit"))
    chosen = low.withColumn("at", F.row_number().over(by_code)).where(F.col("at") <= each).select("lang", "code", "at")
    # As many rows as asked for, so their narrow keys can be broadcast.
    sample = durable(labelled.join(F.broadcast(chosen), ["lang", "code"]).dropDuplicates(["lang", "code"]).repartition(TASKS, "code"), "language-sample")

    short = sample.where(F.octet_length("text") <= landmark_bytes)
    per_lang = max(LEAST_LANDMARKS, landmarks // len(langs))
    first = short.withColumn("at", F.row_number().over(by_code)).where(F.col("at") <= per_lang).select("lang", "code", "text").collect()
    if not first:  # only very long texts
        first = sample.orderBy(F.octet_length("text"), "lang", "code").limit(1).collect()
    marks = Landmarks([r.text for r in sorted(first, key=lambda r: (r.lang, r.code))])
    m, number = len(marks.sizes), {x: i for i, x in enumerate(langs)}
    shared = spark.sparkContext.broadcast(marks)

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram, target, seen = np.zeros((m, m)), np.zeros((m, len(number))), 0
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                some = pdf.iloc[at : at + 256]
                k = np.stack([shared.value.kernel(t) for t in some["text"]])
                y = np.full((len(some), len(number)), -1.0)
                y[np.arange(len(some)), [number[x] for x in some["lang"]]] = 1
                gram, target, seen = gram + k.T @ k, target + k.T @ y, seen + len(some)
        if seen:
            yield pd.DataFrame({"gram": [gram.tobytes()], "target": [target.tobytes()], "seen": [seen]})

    parts = sample.select("lang", "text").mapInPandas(add_up, "gram binary, target binary, seen bigint").collect()
    parts.sort(key=lambda r: r.gram)  # the same sum on every run
    gram = sum(np.frombuffer(r.gram).reshape(m, m) for r in parts)
    target = sum(np.frombuffer(r.target).reshape(m, len(langs)) for r in parts)
    own = np.stack([marks.kernel(r.text) for r in sorted(first, key=lambda r: (r.lang, r.code))])
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # z = k root; the same kernels as K^-1/2, in its eigenbasis
    inner = root.T @ gram @ root + RIDGE * sum(r.seen for r in parts) * np.eye(int(good.sum()))
    coefficients = root @ np.linalg.solve(inner, root.T @ target) / np.sqrt(marks.sizes)[:, None]
    weights = np.add.reduceat(coefficients[marks.owners], marks.begin[:-1], axis=0)
    return Model(langs, marks.codes, weights.astype(np.float32))


def language_of(spark, model: Model, text: Column) -> Column:
    """A struct of ``lang`` and ``score`` (0 to 1) for each text."""
    shared = spark.sparkContext.broadcast(model)

    def classify(texts: pd.Series) -> pd.DataFrame:
        langs, scores = shared.value.classify(texts.tolist())
        return pd.DataFrame({"lang": langs, "score": scores})

    return F.pandas_udf(classify, "lang string, score double")(text)
