"""Remove byte strings that stand in a corpus more than once.

A byte goes if a string of ``length`` bytes that covers it starts in more than
one place, in the same text or another. Texts are judged as they came in.

1. Of each text's ``length``-byte windows, each is filed under one anchor: its
   64-byte string of least hash (the last of equal ones). Equal windows have
   equal anchors at equal places. Anchors met once are done with; that leaves
   a small part of the corpus.
2. For each other anchor its context is cut out: the bytes of all windows
   filed under it. Contexts met twice in full are repeated as a whole.
3. The different contexts of one anchor are searched for common windows by
   merging Burrows-Wheeler transforms (:mod:`interleave`), a bounded number of
   bytes to a task. Anchors with more than ``MANY`` different contexts (a
   passage that very many texts quote) take another exact way: their windows
   are counted by a 128-bit hash over all tasks.

Texts are told by their SHA-256; copies of one text are one text with a count.
Null texts are empty. Texts under ``length`` bytes keep everything. Repeated
rows are copies. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.frames import small_side
from tallyroom.llm.interleave import repeated_starts
from tallyroom.llm.words import U64, _powers, mix
from tallyroom.sources.durable import durable

LENGTH = 400
ANCHOR = 64  # bytes
MANY = 2048  # contexts of an anchor for one task
TASK_BYTES = 1 << 20
BROADCAST_KEYS = 200_000
_CHUNK = 1 << 16
_BASE = 0xD6E8FEB86659FD93
_POWERS = _powers(_BASE, _CHUNK + 4096)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), _CHUNK + 4096)
_PLACES = U64((1 << 20) - 1)


def _hashes(raw: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes from each place on; at most ``_CHUNK + 4096`` bytes."""
    total = np.concatenate((np.zeros(1, dtype=U64), np.cumsum((raw.astype(U64) + U64(1)) * _POWERS[: len(raw)])))
    n = len(raw) - width + 1
    return mix((total[width:] - total[:n]) * _INVERSE[:n])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    n = len(values)
    rows = np.full(-(-n // width) * width, ~U64(0), dtype=U64)
    rows[:n] = values
    rows = rows.reshape(-1, width)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def anchors(blob: bytes, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a text's windows: hash and place of each anchor, first and last window filed there."""
    parts = []
    for at in range(0, max(0, len(blob) - length + 1), _CHUNK):
        raw = np.frombuffer(blob[at : at + _CHUNK + length - 1], dtype=np.uint8)
        h = _hashes(raw, anchor)
        key = (h & ~_PLACES) | (_PLACES - np.arange(len(h), dtype=U64))  # of equal ones the last is least
        place = (_PLACES - (_least(key, length - anchor + 1) & _PLACES)).astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        last = np.append(first[1:], len(place)) - 1
        parts.append((h[place[first]].view(np.int64), place[first] + at, first + at, last + at))
    if not parts:
        return (np.empty(0, dtype=np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*parts))


def _blob(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _ranges(starts: np.ndarray) -> list[tuple[int, int]]:
    """Runs of neighbouring numbers as (first, last)."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), starts[np.append(cut, len(starts) - 1)].tolist()))


def _anchored(docs: DataFrame, text_col: str, length: int) -> DataFrame:
    """One row per different text: ``key``, ``copies``, ``n_bytes`` and its anchors."""

    @F.pandas_udf("fp array<bigint>, at array<int>, first array<int>, last array<int>")
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = [anchors(_blob(t), length) for t in texts]
        return pd.DataFrame({name: [r[i] for r in rows] for i, name in enumerate(("fp", "at", "first", "last"))})

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.sha2(text, 256).alias("key"), F.octet_length(text).cast("bigint").alias("n_bytes"), find(text).alias("anchors"))
    return durable(
        rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.first("n_bytes").alias("n_bytes"), F.first("anchors").alias("anchors")),
        "repeat-anchors",
    )


def _some_texts(docs: DataFrame, keys: DataFrame, text_col: str) -> DataFrame:
    """``(key, text)`` of the listed texts, once each."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.sha2(text, 256).alias("key"), text.alias("text"))
    listed = durable(keys.select("key"), "repeat-keys")
    if listed.count() <= BROADCAST_KEYS:
        listed = F.broadcast(listed)
    return rows.join(listed, "key", "left_semi").dropDuplicates(["key"])


def _contexts(docs: DataFrame, texts: DataFrame, text_col: str, length: int) -> DataFrame:
    """Contexts of anchors met more than once: where they stand, their anchor's place inside, and their bytes."""
    each = texts.select("key", "copies", F.inline(F.arrays_zip("anchors.fp", "anchors.at", "anchors.first", "anchors.last")))
    # Written, so that the join below meets two plain shuffles and a very common passage can be split.
    often = durable(each.groupBy("fp").agg(F.sum("copies").alias("times")).where("times > 1").select("fp"), "repeat-often")
    wanted = durable(
        each.join(small_side(often), "fp").groupBy("key", "copies").agg(F.collect_list(F.struct("fp", "at", "first", "last")).alias("anchors")),
        "repeat-wanted",
    )

    @F.pandas_udf("array<struct<fp:bigint,inside:int,first:int,last:int,digest:binary,context:binary>>")
    def cut(texts: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(texts, lists):
            blob, rows = _blob(text), []
            for a in found:
                context = blob[a["first"] : a["last"] + length]
                inside = a["at"] - a["first"]
                digest = hashlib.blake2b(context, digest_size=16, salt=inside.to_bytes(8, "little")).digest()
                rows.append({"fp": a["fp"], "inside": inside, "first": a["first"], "last": a["last"], "digest": digest, "context": context})
            out.append(rows)
        return pd.Series(out)

    both = _some_texts(docs, wanted, text_col).join(wanted, "key")
    return durable(both.select("key", "copies", F.inline(cut("text", "anchors"))), "repeat-contexts")


def crops(fps: list[int], inside: list[int], contexts: list[bytes], length: int, step: int = ANCHOR) -> tuple[list, list, list, list]:
    """What of each context can lie in a window that another context of its anchor holds.

    Both must agree from the anchor outwards: a side is followed in steps of
    ``step`` bytes as long as some other context reads the same up to there,
    and one step more is kept. Contexts with too little left are left out.
    Gives their numbers, contexts, and the bounds of what is kept.
    """
    seen: Counter = Counter()
    sides = []
    for fp, at, c in zip(fps, inside, contexts):
        left = [hash((fp, k, 0, c[at - k * step : at])) for k in range(1, at // step + 1)]
        right = [hash((fp, k, 1, c[at : at + k * step])) for k in range(1, (len(c) - at) // step + 1)]
        seen.update(left)
        seen.update(right)
        sides.append((left, right))
    out: tuple[list, list, list, list] = ([], [], [], [])
    for i, (at, c, (left, right)) in enumerate(zip(inside, contexts, sides)):
        lo = max(0, at - step * (sum(seen[h] > 1 for h in left) + 1))
        hi = min(len(c), at + step * (sum(seen[h] > 1 for h in right) + 1))
        if hi - lo >= length:
            for column, x in zip(out, (i, c, lo, hi)):
                column.append(x)
    return out


def _common_by_task(contexts: DataFrame, length: int) -> DataFrame:
    """``(digest, lo, hi)``: windows of a context that another context of its anchor holds too."""

    def search(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        cuts = crops(pdf["fp"].tolist(), pdf["inside"].tolist(), pdf["context"].tolist(), length)
        found = repeated_starts([c[lo:hi] for _, c, lo, hi in zip(*cuts)], length)
        digests = pdf["digest"].tolist()
        for i, at, starts in zip(cuts[0], cuts[2], found):
            rows += [(digests[i], lo + at, hi + at) for lo, hi in _ranges(starts)]
        return pd.DataFrame(rows, columns=["digest", "lo", "hi"])

    size = contexts.agg(F.coalesce(F.sum(F.length("context")), F.lit(0)).alias("n")).first().n
    tasks = max(1, math.ceil(size / TASK_BYTES))
    return contexts.groupBy(F.pmod(F.xxhash64("fp"), F.lit(tasks)).alias("task")).applyInPandas(search, "digest binary, lo int, hi int")


def _common_by_hash(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many contexts: windows are counted by hash, whichever task they are in."""

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for digest, context in zip(pdf["digest"], pdf["context"]):
                raw = np.frombuffer(context, dtype=np.uint8)
                for at in range(0, len(raw) - length + 1, _CHUNK):
                    part = raw[at : at + _CHUNK + length - 1]
                    n = len(part) - length + 1
                    yield pd.DataFrame(
                        {
                            "digest": [digest] * n,
                            "start": np.arange(at, at + n),
                            "h": _hashes(part, length).view(np.int64),
                            "g": _hashes(part[::-1] ^ np.uint8(0x5A), length)[::-1].view(np.int64),
                        }
                    )

    each = contexts.select("digest", "context").mapInPandas(windows, "digest binary, start int, h bigint, g bigint")
    each = durable(each, "repeat-windows")
    often = each.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h", "g")
    return each.join(often, ["h", "g"]).select("digest", F.col("start").alias("lo"), F.col("start").alias("hi"))


def repeated_ranges(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """All texts ``(key, copies, n_bytes)``, and of those in part repeated the ranges ``(lo, hi)`` of starts."""
    texts = _anchored(docs, text_col, length)
    contexts = _contexts(docs, texts, text_col, length)
    kinds = durable(
        contexts.groupBy("fp", "digest").agg(F.sum("copies").alias("times"), F.first("inside").alias("inside"), F.first("context").alias("context")), "repeat-kinds"
    )
    per_anchor = kinds.groupBy("fp").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    several = kinds.join(per_anchor, "fp").select("fp", "digest", "inside", "context", "kinds")
    ranges = _common_by_task(several.where(F.col("kinds") <= MANY), length)
    many = durable(several.where(F.col("kinds") > MANY), "repeat-many")
    if many.limit(1).count():
        ranges = ranges.unionByName(_common_by_hash(many, length))
    whole = kinds.where("times > 1").select("digest", F.lit(None).cast("int").alias("lo"), F.lit(None).cast("int").alias("hi"))
    marks = durable(ranges.unionByName(whole), "repeat-ranges")
    placed = contexts.where("copies = 1").select("key", "first", "last", "digest").join(marks, "digest")
    found = placed.select(
        "key",
        F.coalesce(F.col("first") + F.col("lo"), "first").alias("lo"),
        F.coalesce(F.col("first") + F.col("hi"), "last").alias("hi"),
    )
    return texts.drop("anchors"), found


def _keep(blob: bytes, ranges: list, length: int) -> tuple[bytes, int, int]:
    """What is left, how many bytes go and in how many runs."""
    edge = np.zeros(len(blob) + 1, dtype=np.int64)
    for lo, hi in ranges:
        edge[lo] += 1
        edge[hi + length] -= 1
    gone = np.cumsum(edge)[:-1] > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
    return np.frombuffer(blob, dtype=np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def remove_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH, column: str = "_left") -> DataFrame:
    """``docs`` with a struct ``column``: ``n_bytes``, ``n_removed``, ``n_spans``, ``sha256`` and the bytes ``left``.

    ``left`` is null where nothing went.
    """
    texts, ranges = repeated_ranges(docs, text_col, length)
    listed = durable(ranges.groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges")), "repeat-listed")

    @F.pandas_udf("n_removed bigint, n_spans bigint, sha256 string, left binary")
    def take(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        rows = []
        for text, found in zip(texts, lists):
            left, gone, runs = _keep(_blob(text), [(r["lo"], r["hi"]) for r in found], length)
            rows.append((gone, runs, hashlib.sha256(left).hexdigest(), left))
        return pd.DataFrame(rows, columns=["n_removed", "n_spans", "sha256", "left"])

    part = durable(_some_texts(docs, listed, text_col).join(listed, "key").select("key", take("text", "ranges").alias("r")).select("key", "r.*"), "repeat-left")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    judged = texts.join(part, "key", "left").select(
        F.col("key").alias("_key"),
        F.struct(
            "n_bytes",
            F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
            F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("sha256", "key")).alias("sha256"),
            F.when(gone, F.lit(b"")).otherwise(F.col("left")).alias("left"),
        ).alias(column),
    )
    key = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    return docs.withColumn("_text_key", key).join(judged, F.col("_text_key") == F.col("_key")).drop("_text_key", "_key")


def as_text(left: Column) -> Column:
    """Text of the bytes, without the parts of characters that were cut."""

    @F.pandas_udf("string")
    def decode(blobs: pd.Series) -> pd.Series:
        return blobs.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))

    return decode(left)
