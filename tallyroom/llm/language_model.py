"""Score texts by a word-pair model kept as a sharded Elias-Fano trie.

P(w | v) = (1 - SHARE) P(w) + SHARE c(v, w) / c(v), and P(w) after a word v
that training has not seen, with P(w) the smoothed share of w among all
training tokens. Every pair counts, also those met once, so the shares of a
context add up to 1 and P(w | v) to what P(w) adds up to. The trie's first
level holds words, the second the words v before each of them, sorted
within the range that a rising pointer array gives; words, pointers and
contexts are Elias-Fano coded, probabilities are one of 256 levels. A pair is
looked up by successor search inside its word's range.

Neither model nor corpus meets in one place:

1. word counts over all training texts (summed per block of texts first);
2. pair counts, dealt by context v, where c(v) is known; they go on
   to the shard of w, where the trie of that shard is built and written to the
   shared folder as flat byte arrays;
3. all texts again in blocks: the distinct pairs of a block, dealt by w, are
   looked up in the trie of their shard; one row of codes per block and shard
   comes back and meets the block's tokens, numbers of its pairs. A block asks
   for a pair once, however many shards there are.

Shards hold about ``SHARD_TOKENS`` tokens each, so their number grows with
the corpus. Words above a quarter of a shard are hot (at most four times as
many as shards), and so are the start and the end of a text, which all texts
share: their pairs are dealt by both words. A shard with many pairs is
searched by several tasks.

Words are 64-bit hashes. Null and empty texts are an end token. Rows equal in
id and text share one result; null ids are kept. Without training texts all
words are unknown.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.elias_fano import EliasFano
from tallyroom.llm.words import U64, mix, word_hashes
from tallyroom.sources.durable import durable

SHARE = 0.1
SHARD_TOKENS = 2_000_000
LEAST_BITS = 4  # 16 shards at least
END = U64(0x9D39247E33776D41)
START = U64(0x2AF7398005AAA5C7)
_BLOCK_TOKENS = 1 << 20
_BLOCK_TEXTS = 1 << 12
_LEVELS = 256


@dataclass(frozen=True)
class Corpus:
    """Totals of the training texts and how their words are dealt."""

    tokens: int
    distinct: int
    bits: int
    hot: np.ndarray  # hot words, sorted
    hot_counts: np.ndarray

    def p(self, count: np.ndarray) -> np.ndarray:
        return (count + 0.5) / (self.tokens + 0.5 * (self.distinct + 1))

    def _deal(self, by: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Upper bits of the hash; for hot words, of both hashes. Words are told by their upper 40 bits."""
        shard = by >> U64(64 - self.bits)
        hot, upper = self.hot >> U64(24), by >> U64(24)
        if len(hot):
            at = np.flatnonzero(hot[np.minimum(np.searchsorted(hot, upper), len(hot) - 1)] == upper)
            shard[at] = mix(upper[at] ^ mix(other[at] + U64(1))) >> U64(64 - self.bits)
        return shard.astype(np.int64)

    def word_shard(self, w: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Where a pair is looked up; of w the upper 40 bits count, of v the upper 32."""
        return self._deal(w, v >> U64(32))

    def context_shard(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Where pairs of a context are counted. Of w only the upper 40 bits count."""
        return self._deal(v, w >> U64(24))


@dataclass
class Block:
    """Tokens of some texts: words (the end token included), the word before each, and the text's number."""

    words: np.ndarray
    before: np.ndarray
    text: np.ndarray
    keys: np.ndarray


def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[Block]:
    """Texts in blocks of bounded size; a longer text is parted into several blocks."""
    words: list[np.ndarray] = []
    keys: list[int] = []
    size = 0

    def made() -> Block:
        w = np.concatenate(words)
        n = np.array([len(x) for x in words])
        before = np.empty_like(w)
        before[1:] = w[:-1]
        before[np.cumsum(n) - n] = START
        return Block(w, before, np.repeat(np.arange(len(words)), n), np.array(keys, dtype=np.int64))

    for pdf in batches:
        hashes, counts = word_hashes(pdf["text"].tolist())
        at = 0
        for key, n in zip(pdf["key"].to_numpy(), counts):
            own = np.append(hashes[at : at + n], END)
            at += n
            if size and (size + len(own) > _BLOCK_TOKENS or len(keys) == _BLOCK_TEXTS):
                yield made()
                words, keys, size = [], [], 0
            if len(own) > _BLOCK_TOKENS:
                for lo in range(0, len(own), _BLOCK_TOKENS):
                    part = own[lo : lo + _BLOCK_TOKENS]
                    before = np.append(own[lo - 1] if lo else START, part[:-1])
                    yield Block(part, before, np.zeros(len(part), dtype=np.int64), np.array([key]))
                continue
            words.append(own)
            keys.append(key)
            size += len(own)
    if size:
        yield made()


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    if not len(sorted_values):
        return np.empty(0, dtype=np.int64)
    return np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1]))


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard with the places of its entries, in their order."""
    order = np.argsort(shard.astype(np.uint32), kind="stable")
    starts = np.append(_runs(shard[order]), len(shard))
    for lo, hi in zip(starts[:-1], starts[1:]):
        yield int(shard[order[lo]]), order[lo:hi]


def corpus(texts: DataFrame) -> tuple[Corpus, DataFrame]:
    """Totals, and the written table ``(w, c)`` of word counts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches):
            w, c = np.unique(block.words, return_counts=True)
            yield pd.DataFrame({"w": w.view(np.int64), "c": c})

    counts = durable(texts.mapInPandas(count, "w bigint, c bigint").groupBy("w").agg(F.sum("c").alias("c")), "lm-words")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    bits = max(LEAST_BITS, math.ceil(math.log2(max(1, total.n / SHARD_TOKENS))))
    end = int(END.astype(np.int64))
    hot = counts.where((F.col("c") * (4 << bits) > total.n) | (F.col("w") == end)).collect()  # at most 4 << bits
    # Every text has one start as it has one end: the context of all first words.
    pairs = sorted([(int(np.int64(r.w).astype(U64)), r.c) for r in hot] + [(int(START), r.c) for r in hot if r.w == end])
    return Corpus(
        total.n, total.v, bits, np.array([w for w, _ in pairs], dtype=U64), np.array([c for _, c in pairs], dtype=np.int64)
    ), counts


def _pair_counts(texts: DataFrame, info: Corpus) -> DataFrame:
    """Pair counts by block, dealt by context: contexts, words per context, words (upper 40 bits), times."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches):
            v, w = block.before, block.words
            _, first, times = np.unique(mix(v * U64(0xD6E8FEB86659FD93) + (w >> U64(24))), return_index=True, return_counts=True)
            v, w = v[first], w[first]
            rows = []
            for shard, at in _by_shard(info.context_shard(v, w)):
                at = at[np.argsort(v[at], kind="stable")]
                starts = _runs(v[at])
                rows.append(
                    (
                        shard,
                        v[at][starts].tobytes(),
                        np.diff(np.append(starts, len(at))).astype("<u4").tobytes(),
                        *_upper_bytes(w[at] >> U64(24)),
                        times[at].astype("<u4").tobytes(),
                    )
                )
            yield pd.DataFrame(rows, columns=["shard", "v", "n", "hi", "lo", "times"])

    return texts.mapInPandas(count, "shard int, v binary, n binary, hi binary, lo binary, times binary")


def _joined(column: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=kind)


def _upper_bytes(upper: np.ndarray) -> tuple[bytes, bytes]:
    """The upper 40 bits of words as four bytes and one."""
    return (upper >> U64(8)).astype("<u4").tobytes(), (upper & U64(255)).astype(np.uint8).tobytes()


def _upper(pdf: pd.DataFrame) -> np.ndarray:
    w = _joined(pdf["hi"], "<u4").astype(U64)
    w <<= U64(8)
    w |= _joined(pdf["lo"], "u1")
    return w


def _shared_pairs(counts: DataFrame, info: Corpus) -> DataFrame:
    """All pairs with their share of the context, dealt by word; ``tokens`` counts their times."""

    def keep(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.repeat(_joined(pdf["v"], "<u8"), _joined(pdf["n"], "<u4"))
        w = _upper(pdf)
        times = _joined(pdf["times"], "<u4")
        del pdf
        order = np.lexsort((w, v)).astype(np.int32)
        v = v[order]  # one after the other: of each only one copy at a time
        w = w[order]
        times = times[order]
        del order
        starts = _runs(mix(v) + w)  # neighbours equal in both
        v = v[starts]
        w = w[starts]
        times = np.add.reduceat(times, starts, dtype=np.int64)
        del starts
        begins = _runs(v)
        total = np.repeat(np.add.reduceat(times, begins), np.diff(np.append(begins, len(v))))
        if len(info.hot):  # dealt by both words: the whole count is known from step 1
            at = np.minimum(np.searchsorted(info.hot, v), len(info.hot) - 1)
            total = np.where(info.hot[at] == v, info.hot_counts[at], total)
        share = (times / total).astype(np.float32)
        rows = []
        for shard, at in _by_shard(info.word_shard(w << U64(24), v)):
            hi, lo = _upper_bytes(w[at])
            rows.append((shard, int(times[at].sum()), hi, lo, (v[at] >> U64(32)).astype("<u4").tobytes(), share[at].tobytes()))
        return pd.DataFrame(rows, columns=["shard", "tokens", "hi", "lo", "v", "share"])

    return counts.groupBy("shard").applyInPandas(keep, "shard int, tokens bigint, hi binary, lo binary, v binary, share binary")


@dataclass
class Trie:
    """One shard: words, their counts, a pointer to each word's contexts, contexts, and probability levels."""

    words: EliasFano
    counts: np.ndarray
    pointers: EliasFano
    contexts: EliasFano
    codes: np.ndarray
    book: np.ndarray

    @classmethod
    def build(cls, w: np.ndarray, c: np.ndarray, pair_w: np.ndarray, pair_v: np.ndarray, share: np.ndarray, info: Corpus) -> Trie:
        """From sorted words with counts and pairs (upper 40 bits of the word, 32 of the context)."""
        upper = w >> U64(24)
        key = np.searchsorted(upper, pair_w).astype(U64)
        known = upper[np.minimum(key, U64(max(0, len(w) - 1))).astype(np.intp)] == pair_w if len(w) else np.zeros(len(pair_w), bool)
        if not known.all():
            key, pair_v, share = key[known], pair_v[known], share[known]
        del known
        key <<= U64(32)
        key |= pair_v
        order = np.argsort(key, kind="stable").astype(np.uint32)
        key = key[order]
        share = share[order]
        del order
        starts = _runs(key)
        if len(starts) < len(key):
            key, share = key[starts], share[starts]
        del starts
        at = (key >> U64(32)).astype(np.int64)
        log_p = np.log10((1 - SHARE) * info.p(c[at]) + SHARE * share)
        book = np.unique(np.quantile(log_p, np.linspace(0, 1, _LEVELS))) if len(log_p) else np.zeros(1)
        codes = np.searchsorted((book[1:] + book[:-1]) / 2, log_p).astype(np.uint8)
        del log_p
        pointers = np.searchsorted(at, np.arange(len(w) + 1)).astype(U64)
        return cls(
            EliasFano.encode(w, 1 << 64),
            c,
            EliasFano.encode(pointers, len(key) + 1),
            EliasFano.encode(key, max(1, len(w)) << 32),
            codes,
            book,
        )

    def to_row(self) -> dict[str, bytes]:
        return {
            "words": self.words.to_bytes(),
            "counts": self.counts.astype("<i8").tobytes(),
            "pointers": self.pointers.to_bytes(),
            "contexts": self.contexts.to_bytes(),
            "codes": self.codes.tobytes(),
            "book": self.book.astype("<f8").tobytes(),
        }

    @classmethod
    def from_row(cls, row) -> Trie:
        return cls(
            EliasFano.from_bytes(row["words"]),
            np.frombuffer(row["counts"], dtype="<i8"),
            EliasFano.from_bytes(row["pointers"]),
            EliasFano.from_bytes(row["contexts"]),
            np.frombuffer(row["codes"], dtype=np.uint8),
            np.frombuffer(row["book"], dtype="<f8"),
        )

    def find_words(self, w: np.ndarray) -> np.ndarray:
        """Place of each word, -1 if unknown."""
        at = self.words.successor(w)
        inside = np.minimum(at, max(0, self.words.n - 1))
        return np.where((at < self.words.n) & (self.words.get(inside) == w), at, -1) if self.words.n else np.full(len(w), -1)

    def find_pairs(self, place: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Probability level of word ``place`` after context v (upper 32 bits); -1 if not stored."""
        out = np.full(len(place), -1, dtype=np.int16)
        known = np.flatnonzero(place >= 0)
        if not self.contexts.n or not len(known):
            return out
        begin, end = self.pointers.get(place[known]).astype(np.int64), self.pointers.get(place[known] + 1).astype(np.int64)
        known, begin, end = known[begin < end], begin[begin < end], end[begin < end]
        key = (place[known].astype(U64) << U64(32)) | v[known].astype(U64)
        at = self.contexts.successor(key)
        inside = np.minimum(at, self.contexts.n - 1)
        hit = (at >= begin) & (at < end) & (self.contexts.get(inside) == key)
        out[known[hit]] = self.codes[inside[hit]]
        return out


_TRIE = "shard int, tokens bigint, words binary, counts binary, pointers binary, contexts binary, codes binary, book binary"


def _tries(words: DataFrame, pairs: DataFrame, info: Corpus) -> DataFrame:
    """The model: one row per shard, in the shared folder."""
    shards = 1 << info.bits
    dealt = words.withColumn("shard", F.shiftrightunsigned("w", 64 - info.bits).cast("int"))

    def build(key: tuple, counted: pd.DataFrame, kept: pd.DataFrame) -> pd.DataFrame:
        w = np.append(counted["w"].to_numpy(np.int64).view(U64), info.hot)
        c = np.append(counted["c"].to_numpy(np.int64), info.hot_counts)
        w, first = np.unique(w, return_index=True)  # a hot word stands in every shard
        trie = Trie.build(
            w, c[first], _upper(kept), _joined(kept["v"], "<u4"), _joined(kept["share"], "<f4"), info
        )
        return pd.DataFrame([{"shard": key[0], "tokens": int(kept["tokens"].sum()), **trie.to_row()}])

    every = words.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    all_kept = pairs.unionByName(
        every.select("shard", F.lit(0).cast("bigint").alias("tokens"), *[F.lit(b"").alias(x) for x in ("hi", "lo", "v", "share")])
    )
    return durable(
        dealt.groupBy("shard").cogroup(all_kept.groupBy("shard")).applyInPandas(build, _TRIE), "lm-trie"
    )


_ASKED = "shard int, part int, block bigint, w binary, n binary, v binary"
_ANSWER = "block bigint, shard int, n binary, counts binary, stored binary, codes binary"
_OWN = "block bigint, keys binary, sizes binary, low binary, high binary"


def _numbered(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, Block, int]]:
    """Each block with a number that no other has, and the task's number."""
    task = TaskContext.get().partitionId()
    for number, block in enumerate(blocks(batches)):
        yield (task << 32) + number, block, task + number


def _block_pairs(block: Block, info: Corpus) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Distinct pairs of a block (word, 32 bits of the context), the pair at each token, and the pairs of each shard."""
    distinct, rank = np.unique(block.words, return_inverse=True)
    key, at = np.unique((rank.astype(U64) << U64(32)) | (block.before >> U64(32)), return_inverse=True)
    w, v = distinct[(key >> U64(32)).astype(np.int64)], key & U64(0xFFFFFFFF)
    return w, v, at, list(_by_shard(info.word_shard(w, v << U64(32))))


def _asked(texts: DataFrame, info: Corpus, tasks: list[int]) -> DataFrame:
    """The distinct pairs of each block, one row for each shard that may know some."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for own, block, turn in _numbered(batches):
            w, v, _, dealt = _block_pairs(block, info)
            rows = []
            for shard, at in dealt:
                starts = _runs(w[at])
                sizes = np.diff(np.append(starts, len(at)))
                asked = (w[at][starts].tobytes(), sizes.astype("<u4").tobytes(), v[at].astype("<u4").tobytes())
                rows.append((shard, turn % tasks[shard], own, *asked))
            yield pd.DataFrame(rows, columns=["shard", "part", "block", "w", "n", "v"])

    return texts.mapInPandas(ask, _ASKED)


def _own(texts: DataFrame, info: Corpus) -> DataFrame:
    """Each block's texts, their numbers of tokens, and at each token its pair's place in the answers (two bytes and one)."""

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for number, block, _ in _numbered(batches):
            w, _, at, dealt = _block_pairs(block, info)
            place = np.empty(len(w), dtype=np.uint32)
            place[np.concatenate([pairs for _, pairs in dealt])] = np.arange(len(w))
            at = place[at]
            lengths = np.bincount(block.text, minlength=len(block.keys)).astype("<u4")
            row = (number, block.keys.tobytes(), lengths.tobytes(), (at & 0xFFFF).astype("<u2").tobytes(), (at >> 16).astype(np.uint8).tobytes())
            yield pd.DataFrame([row], columns=["block", "keys", "sizes", "low", "high"])

    return texts.mapInPandas(own, _OWN)


def look_up(row, trie: Trie) -> tuple:
    """What a shard knows of the pairs in one row: counts of words, whether a pair is stored, and the levels of those that are."""
    w, n = np.frombuffer(row.w, dtype="<u8"), np.frombuffer(row.n, dtype="<u4")
    place = trie.find_words(w)
    counts = np.where(place >= 0, trie.counts[np.maximum(place, 0)] if len(trie.counts) else 0, 0)
    codes = trie.find_pairs(np.repeat(place, n), np.frombuffer(row.v, dtype="<u4"))
    stored = codes >= 0
    return row.block, row.shard, row.n, counts.astype("<i8").tobytes(), np.packbits(stored).tobytes(), codes[stored].astype(np.uint8).tobytes()


def _answered(answers: pd.DataFrame, owns: pd.DataFrame, info: Corpus, books: dict[int, np.ndarray]) -> pd.DataFrame:
    """Sums by text of one block, from its own row and the shards' answers."""
    if len(owns) != 1 or not len(answers):
        raise RuntimeError("texts changed between two reads: pass a written table")
    own, answers = owns.iloc[0], answers.sort_values("shard")
    count = np.repeat(_joined(answers["counts"], "<i8"), _joined(answers["n"], "<u4"))
    stored = []
    for r in answers.itertuples():
        p = np.full(int(np.frombuffer(r.n, dtype="<u4").sum()), np.nan)
        known = np.unpackbits(np.frombuffer(r.stored, dtype=np.uint8), count=len(p)).astype(bool)
        p[known] = books[r.shard][np.frombuffer(r.codes, dtype=np.uint8)]
        stored.append(p)
    stored = np.concatenate(stored)
    base, known = np.log10(info.p(count)), count > 0
    share = SHARE if info.tokens else 0.0
    score = np.where(np.isnan(stored), np.log10(1 - share) + base, stored)
    # After a word that training has not seen, the next token has the whole of P(w): its part is added here.
    score = score - np.log10(1 - share) * ~known
    keys, lengths = np.frombuffer(own["keys"], dtype="<i8"), np.frombuffer(own["sizes"], dtype="<u4").astype(np.int64)
    at = np.frombuffer(own["low"], dtype="<u2") | (np.frombuffer(own["high"], dtype=np.uint8).astype(np.uint32) << 16)
    starts = np.cumsum(lengths) - lengths  # a text has a token at least
    return pd.DataFrame(
        {
            "key": keys,
            "n_tokens": lengths,
            "n_known": np.add.reduceat(known[at], starts, dtype=np.int64),
            "base_score": np.add.reduceat(base[at], starts),
            "score": np.add.reduceat(score[at], starts),
        }
    )


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``held_out``, token counts, ``train_tokens``, ``base_score`` and ``score`` (log10)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col), F.coalesce(held_out, F.lit(False)).alias("held_out"), text.alias("text"), F.xxhash64(F.col(id_col), text).alias("key")
    )
    training = rows.where(~F.col("held_out")).select("key", "text")
    info, words = corpus(training)
    pairs = _shared_pairs(_pair_counts(training, info), info)
    model = _tries(words, pairs, info)
    known = {r.shard: r for r in model.select("shard", "tokens", "book").collect()}  # one row of 2 KB per shard
    tasks = [max(1, math.ceil(known[s].tokens / (8 * SHARD_TOKENS))) for s in range(1 << info.bits)]
    books = {s: np.frombuffer(r.book, dtype="<f8") for s, r in known.items()}
    texts = rows.select("key", "text")
    asked = _asked(texts, info, tasks)
    parts = F.element_at(F.array(*[F.lit(t) for t in tasks]), F.col("shard") + 1) if max(tasks) > 1 else F.lit(1)
    served = model.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))

    def answer(asked: pd.DataFrame, tries: pd.DataFrame) -> pd.DataFrame:
        trie = Trie.from_row(tries.iloc[0])
        return pd.DataFrame([look_up(r, trie) for r in asked.itertuples()], columns=["block", "shard", "n", "counts", "stored", "codes"])

    sums = (
        asked.groupBy("shard", "part")
        .cogroup(served.groupBy("shard", "part"))
        .applyInPandas(answer, _ANSWER)
        .groupBy("block")
        .cogroup(_own(texts, info).groupBy("block"))
        .applyInPandas(
            lambda answers, owns: _answered(answers, owns, info, books),
            "key bigint, n_tokens bigint, n_known bigint, base_score double, score double",
        )
        .groupBy("key")
        .agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    )
    listed = rows.select(id_col, "held_out", "key")
    times = listed.groupBy("key").agg(F.count(F.lit(1)).alias("times"))
    shared = sums.join(times, "key")
    return listed.join(shared, "key").select(
        id_col,
        "held_out",
        *[F.expr(f"{c} div times").alias(c) for c in ("n_tokens", "n_known")],
        F.lit(info.tokens).cast("bigint").alias("train_tokens"),
        *[(F.col(c) / F.col("times")).alias(c) for c in ("base_score", "score")],
    )
