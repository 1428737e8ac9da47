"""Pack token sequences into as few fixed-size ones as possible: vector best fit.

A text longer than a sequence is cut into full pieces (the first may be
shorter). Full pieces need no search. The rest are packed: pieces in falling
order of size go to the open sequence that has room in every capacity (tokens,
documents, attention cost, the sum of squared lengths) and scores best: by the
weighted squared norm of what would stay free (``norm``, best fit), or by the
weighted dot product of demand and free room (``dot``).

Pieces are dealt at random into blocks of ``block_rows``, each packed by one
task; a block wastes at most the room of its last few sequences, about one in
a thousand, so the loss does not grow with the table. The block comes from the
written row's place, so repeated rows spread as well.

Null and empty texts are one piece that holds the end token only. Repeated
rows are packed each. Ties go to the older sequence, equal pieces by place. An
empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroom.operators.ranking import _AT
from tallyroom.sources.durable import durable

MAX_TOKENS = 1024
END_ID = 2
BLOCK_ROWS = 4096

# Fixed value: the pattern by which byte-level BPE parts a text before merging.
_PARTS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts of these characters only, where both libraries' character tables agree, take the faster one.
_COMMON = re.compile("[\x00-ɏ‐-‟…€]*")


@cache
def _encoder(path: str):
    """Ids of a text by the tokenizer file at ``path``; loaded once a worker.

    The same vocabulary runs in ``tiktoken``, about four times as fast. Texts
    with characters outside ``_COMMON`` or with a special token's string go to
    ``tokenizers`` itself.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the file
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    special = [t["content"] for t in spec.get("added_tokens", [])]
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("own", pat_str=_PARTS, mergeable_ranks=ranks, special_tokens={})

    @cache
    def slow():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    def encode(text: str) -> np.ndarray:
        if _COMMON.fullmatch(text) and not any(s in text for s in special):
            return fast.encode_to_numpy(text, disallowed_special=()).astype("<u4")
        return np.array(slow().encode(text, add_special_tokens=False).ids, dtype="<u4")

    return encode


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    max_tokens: int = MAX_TOKENS,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of each text: id, ``piece``, ``start``, ``length`` and ``ids`` (little-endian 32-bit, as bytes)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer)
        for batch in batches:
            rows, keys = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(encode(text or ""), np.array([end_id], dtype="<u4"))
                at, end, piece = 0, len(ids) % max_tokens or max_tokens, 0
                while at < len(ids):
                    rows.append((piece, at, end - at, ids[at:end].tobytes()))
                    keys.append(i)
                    at, end, piece = end, end + max_tokens, piece + 1
            piece, start, length, ids = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(keys, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["id", "piece", "start", "length", "ids"],
            )

    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(cut, f"id {id_type}, piece int, start bigint, length bigint, ids binary")
        .withColumnRenamed("id", id_col)
    )


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds. The defaults for documents and cost never bind before the tokens do."""

    tokens: int = MAX_TOKENS
    documents: int = MAX_TOKENS
    cost: int = MAX_TOKENS * MAX_TOKENS
    weights: tuple[float, float, float] = (1.0, 0.001, 0.001)
    rule: str = "norm"


def best_fit(lengths: np.ndarray, capacity: Capacity = Capacity()) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, none of which may exceed the capacity alone."""
    limit = np.array([capacity.tokens, capacity.documents, capacity.cost], dtype=np.float64)
    weight = np.array(capacity.weights)
    need = np.stack([lengths, np.ones_like(lengths), lengths.astype(np.int64) ** 2], axis=1) / limit
    if (need > 1).any():
        raise ValueError("a piece exceeds a capacity of its own")
    free = np.ones((len(lengths), 3))
    used = np.zeros(len(lengths), dtype=np.int64)
    alive = np.empty(0, dtype=np.int64)  # open sequences that may still take a piece
    which, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    made, smallest, eps = 0, need.min(axis=0) if len(need) else None, 1e-9
    for n, i in enumerate(np.argsort(-lengths, kind="stable")):
        room = free[alive]
        fits = np.flatnonzero((room + eps >= need[i]).all(axis=1))
        if len(fits):
            left = room[fits] - need[i]
            score = (left * left) @ weight if capacity.rule == "norm" else -(room[fits] * need[i]) @ weight
            b = alive[fits[np.argmin(score)]]
        else:
            b, made = made, made + 1
            alive = np.append(alive, b)
        which[i], offset[i] = b, used[b]
        used[b] += lengths[i]
        free[b] -= need[i]
        if n % 256 == 255:
            alive = alive[(free[alive] + eps >= smallest).all(axis=1)]
    return which, offset


def pack(pieces: DataFrame, capacity: Capacity = Capacity(), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``pieces`` (any columns, and ``length``) with ``sequence_id`` and gapless ``offset``."""
    rows = durable(pieces.withColumn(_AT, F.monotonically_increasing_id()), "pieces")
    full = F.col("length") == capacity.tokens
    alone = rows.where(full).withColumns({"sequence_id": -1 - F.col(_AT), "offset": F.lit(0).cast("bigint")})
    blocks = max(1, math.ceil(rows.where(~full).count() / block_rows))
    schema = T.StructType([*rows.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def fill(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop(columns="_block").sort_values(_AT)
        which, offset = best_fit(pdf["length"].to_numpy(), capacity)
        return pdf.assign(sequence_id=(np.int64(key[0]) << 32) + which, offset=offset)

    together = (
        rows.where(~full).withColumn("_block", F.pmod(F.xxhash64(_AT), F.lit(blocks))).groupBy("_block").applyInPandas(fill, schema)
    )
    return alone.unionByName(together).drop(_AT)
