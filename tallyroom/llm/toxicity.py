"""Score texts for toxicity with a misspelling-tolerant lexicon and its context.

The lexicon is learned from labelled rows: words, and stems that start many
words, found far more often in toxic texts than in others. It stands in a
trie. A Levenshtein automaton (edits allowed: 0 under four letters, 1 up to
seven, 2 from eight) is intersected with the trie; the product automaton is
made deterministic lazily, state by state, so a word costs one table step a
letter. Look-alike digits and signs are read as letters first; other signs
among the letters of a token are also left out. Misspelled hits
count by how much more often the term's misspellings stand in toxic labelled
texts than in others, so a term whose neighbours are ordinary words gains
nothing from them.

Around each hit a window of words is scored: quotation marks that enclose it
and reporting words speak for a quotation, second-person words for abuse. The
hit's weight is split accordingly into a direct and a quoted share, and a
logistic regression on a handful of sums, with a prior, gives the score.

``max_rows`` bounds the labelled rows the model is fitted on (those of
smallest hash; the fit is the only use). Every text is scored whole. Null and
empty texts score what a text without hits does; without usable labels the
lexicon is empty and all texts score alike, below one half. Rows with equal
text score alike; labels that repeat an id with both values are left out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.sources.durable import durable

MAX_ROWS = 20_000  # labelled rows of the fit
MAX_TERMS = 2_000
MIN_DOCS = 5  # toxic texts a term must stand in
MAX_CHANCE = 1e-4  # that a word without meaning stands in so many toxic texts among those it is in
MIN_LOG_ODDS = 2.5
STEMS = range(4, 9)  # letters of a stem
WINDOW = 6

# Signs read as letters, quotation marks, cue words of four languages.
_LOOKS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"})
_QUOTES = "\"“”„«»‹›"
_REPORT = frozenset(
    "said says say called calls wrote writes quoted quote reported word term dijo dice llamó escribió sagte sagt nannte schrieb dit appelé écrit mot palabra wort".split()
)
_SECOND = frozenset("you your you're u du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted eres ustedes".split())
_WORD = re.compile(r"[^\W_](?:[^\W_]|[@$](?=\w))*")
_SIGNS = re.compile(r"[\W_]+")


def allowed_edits(term: str) -> int:
    return 0 if len(term) < 4 else 1 if len(term) < 8 else 2


class Lexicon:
    """Terms in a trie, met with a lazily determinised Levenshtein automaton.

    ``stems`` match any word that begins with them, without edits.
    """

    _MAX_STATES = 20_000
    _MAX_HELD = 1_000_000  # trie nodes in all states

    def __init__(self, terms: list[str], stems: list[str]):
        self.terms, self.stems = list(terms), list(stems)
        self.children: list[dict[str, int]] = [{}]
        self.term_at: dict[int, int] = {}
        self.edits = [0]  # most edits any term below may take
        for i, term in enumerate(self.terms):
            self.term_at[self._insert(term, allowed_edits(term))] = i
        self._starts = tuple(self.stems)
        self._reset()

    def _insert(self, term: str, edits: int) -> int:
        node = 0
        self.edits[0] = max(self.edits[0], edits)
        for c in term:
            if c not in self.children[node]:
                self.children[node][c] = len(self.children)
                self.children.append({})
                self.edits.append(0)
            node = self.children[node][c]
            self.edits[node] = max(self.edits[node], edits)
        return node

    def __reduce__(self):
        return Lexicon, (self.terms, self.stems)

    def _reset(self) -> None:
        self._ids: dict[frozenset, int] = {}
        self._held = 0
        self._sets: list[frozenset] = []
        self._steps: list[dict[str, int]] = []
        self._accepts: list[tuple[int, int] | None] = []
        self._start, self._dead = self._state({0: 0}), self._state({})

    def trim(self) -> None:
        """Forget the states built so far if they have become many or large."""
        if len(self._sets) > self._MAX_STATES or self._held > self._MAX_HELD:
            self._reset()

    def _state(self, cost: dict[int, int]) -> int:
        """Number of the state that holds each trie node at its least cost, letters left out included."""
        todo = list(cost)
        while todo:
            node = todo.pop()
            e = cost[node] + 1
            for child in self.children[node].values():
                if e <= self.edits[child] and e < cost.get(child, 9):
                    cost[child] = e
                    todo.append(child)
        key = frozenset(cost.items())
        if key not in self._ids:
            self._ids[key] = len(self._sets)
            self._sets.append(key)
            self._held += len(key)
            self._steps.append({})
            ends = [(e, self.term_at[n]) for n, e in key if n in self.term_at and e <= allowed_edits(self.terms[self.term_at[n]])]
            self._accepts.append((min(ends)[1], min(ends)[0]) if ends else None)
        return self._ids[key]

    def _step(self, state: int, letter: str) -> int:
        cost: dict[int, int] = {}
        for node, e in self._sets[state]:
            if e + 1 <= self.edits[node] and e + 1 < cost.get(node, 9):  # a letter too many
                cost[node] = e + 1
            for c, child in self.children[node].items():
                spent = e + (c != letter)
                if spent <= self.edits[child] and spent < cost.get(child, 9):
                    cost[child] = spent
        target = self._state(cost)
        self._steps[state][letter] = target
        return target

    def match(self, word: str) -> tuple[int, int] | None:
        """``(entry, edits)`` of the nearest term, or a stem's entry (after the terms); None without."""
        steps, state = self._steps, self._start
        for letter in word:
            following = steps[state].get(letter)
            state = self._step(state, letter) if following is None else following
            if state == self._dead:
                break
        best = self._accepts[state]
        if best is not None and best[1] == 0:
            return best
        if self._starts and word.startswith(self._starts):
            return len(self.terms) + next(i for i, s in enumerate(self.stems) if word.startswith(s)), 0
        return best


def words_of(raw: str) -> list[str]:
    """Lower-case words in a token between blanks; digits and signs that stand for letters are replaced."""
    if raw.isalpha():
        return [raw.lower()]
    out = []
    for w in _WORD.findall(raw.lower()):
        if not w.isalpha() and any(c.isalpha() for c in w):
            w = w.translate(_LOOKS)
        out.append(w)
    return out


def unmasked(raw: str) -> str | None:
    """A token with signs among its letters ("id*ot", "i.d.i.o.t") as one word without them; None for others."""
    token = raw.lower()
    first = next((i for i, c in enumerate(token) if c.isalnum()), len(token))
    last = next((i for i in range(len(token), first, -1) if token[i - 1].isalnum()), first)
    token = token[first:last]
    if token.isalnum() or len(token) > 60:
        return None
    word = _SIGNS.sub("", token.translate(_LOOKS))
    return word if word.isalpha() and 4 <= len(word) <= 30 and word not in words_of(raw) else None


@dataclass
class Model:
    lexicon: Lexicon
    exact: np.ndarray  # weight of a hit by entry
    near: np.ndarray  # weight of a misspelled hit by entry
    weights: np.ndarray
    _known: dict = field(default_factory=dict, repr=False)

    #: Constant, direct hits, quoted hits, direct hits a word; where the fit starts from, and how firmly it is held there.
    PRIOR = np.array([-4.0, 1.5, 0.0, 1.5])
    FIRM = np.array([2.0, 2.0, 200.0, 2.0])
    N_FEATURES = 4
    SHORT = 50  # texts under so many words count as that long

    def __getstate__(self):
        return {**self.__dict__, "_known": {}}

    def hit(self, raw: str) -> tuple[int, int] | None:
        """Strongest match among the words of a token; remembered, up to a bound."""
        found = [m for w in words_of(raw) if (m := self.lexicon.match(w))]
        if (joined := unmasked(raw)) and (m := self.lexicon.match(joined)):
            found.append((m[0], max(1, m[1])))  # masked letters count as a misspelling
        best = min(found, key=lambda m: (m[1], m[0])) if found else None
        if len(self._known) > 300_000:
            self._known.clear()
        self.lexicon.trim()
        self._known[raw] = best
        return best

    def hits(self, text: str) -> list[tuple[int, int, int, list[str]]]:
        """``(place, entry, edits, tokens)`` of each hit."""
        tokens = text.split()
        get, hit = self._known.get, self.hit
        matched = {t: m for t in set(tokens) if (m := hit(t) if (m := get(t, 0)) == 0 else m)}
        if not matched:
            return []
        return [(i, *matched[t], tokens) for i, t in enumerate(tokens) if t in matched]

    def features(self, text: str | None, hits: list | None = None) -> np.ndarray:
        direct = quoted = 0.0
        hits = self.hits(text or "") if hits is None else hits
        for i, entry, edits, tokens in hits:
            weight = self.near[entry] if edits else self.exact[entry]
            share = direct_share(tokens, i)
            direct += weight * share
            quoted += weight * (1 - share)
        n = max(self.SHORT, len(hits[0][3]) if hits else 0)
        return np.array([1.0, math.log1p(direct), math.log1p(quoted), math.log1p(100 * direct / n)])

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def direct_share(tokens: list[str], at: int, window: int = WINDOW) -> float:
    """How far a hit is abuse rather than a quotation: 0 to 1, by the words around it."""
    before, after = tokens[max(0, at - window) : at], tokens[at + 1 : at + 1 + window]
    own = tokens[at]
    opened = own[0] in _QUOTES or sum(c in _QUOTES for t in before for c in t) % 2 == 1
    closed = own.rstrip(".,;:!?")[-1:] in tuple(_QUOTES) or any(c in _QUOTES for t in after for c in t)
    around = [t.strip(".,;:!?()" + _QUOTES).lower() for t in before + after]
    tilt = 3.5 - 6.0 * (opened and closed) - 1.0 * sum(w in _REPORT for w in around) + 0.5 * sum(w in _SECOND for w in around)
    return 1 / (1 + math.exp(-tilt))


def log_odds(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int, prior: float = 0.5) -> np.ndarray:
    return np.log((pos + prior) / (n_pos + 2 * prior)) - np.log((neg + prior) / (n_neg + 2 * prior))


def chance(pos: int, neg: int, n_pos: int, n_neg: int) -> float:
    """Probability that ``pos`` or more of ``pos + neg`` texts are toxic if the term says nothing."""
    n, q = pos + neg, min(max(n_pos / max(1, n_pos + n_neg), 1e-12), 1 - 1e-12)
    log_n = math.lgamma(n + 1)
    return sum(
        math.exp(log_n - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(q) + (n - k) * math.log1p(-q)) for k in range(pos, n + 1)
    )


def choose_terms(counts: list[tuple[str, bool, int, int]], n_pos: int, n_neg: int) -> tuple[list[str], list[str]]:
    """Terms and stems from ``(text, is stem, toxic texts, other texts)``.

    A stem counts only if it is found in clearly more texts than the most
    frequent word it covers; of nested stems the shortest is kept.
    """
    rows = [
        (t, s, p, float(log_odds(np.float64(p), np.float64(n), n_pos, n_neg)))
        for t, s, p, n in counts
        if p >= MIN_DOCS and chance(p, n, n_pos, n_neg) <= MAX_CHANCE
    ]
    rows = sorted((r for r in rows if r[3] >= MIN_LOG_ODDS), key=lambda r: (-r[2], r[0]))[: 4 * MAX_TERMS]
    words = {t: p for t, s, p, _ in rows if not s}
    stems: list[str] = []
    for t, s, p, _ in sorted(rows, key=lambda r: (len(r[0]), r[0])):
        if s and not any(t.startswith(k) for k in stems):
            most = max((q for w, q in words.items() if w.startswith(t)), default=0)
            if p >= max(2 * MIN_DOCS, 1.5 * most):
                stems.append(t)
    # words that a stem covers stay terms: stems take no edits, so their misspellings are found by the trie
    return list(words)[:MAX_TERMS], stems[:MAX_TERMS]


def _fit_weights(x: np.ndarray, y: np.ndarray, prior: np.ndarray, strength: np.ndarray) -> np.ndarray:
    """Penalised logistic regression towards ``prior`` by Newton steps."""
    w = prior.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + strength * (w - prior)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(strength)
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(
    docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS
) -> Model:
    """Learn from at most ``max_rows`` labelled rows for which ``train`` (on the id) holds."""
    chosen = (
        labels.where(train & F.col("toxic").isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_label_id"))
        .agg(F.min("toxic").alias("y"), F.max("toxic").alias("_y"))
        .where(F.col("y") == F.col("_y"))
        .orderBy(F.xxhash64("_label_id"), "_label_id")
        .limit(max_rows)
        .select("_label_id", F.col("y").cast("int").alias("y"))
    )
    sample = durable(
        docs.where(F.col(text_col).isNotNull())
        .join(F.broadcast(chosen), F.col(id_col) == F.col("_label_id"))  # at most max_rows ids
        .groupBy(F.col(text_col).alias("text"))  # copies are no further evidence, texts labelled both ways are none
        .agg(F.min("y").alias("y"), F.max("y").alias("_y"))
        .where(F.col("y") == F.col("_y"))
        .select("text", "y"),
        "toxicity-sample",
    )
    sizes = {r.y: r.n for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = sizes.get(1, 0), sum(n for y, n in sizes.items() if y != 1)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            tally: Counter = Counter()
            for text, y in zip(pdf["text"], pdf["y"]):
                words = {w for raw in set(text.split()) for w in words_of(raw) if 2 < len(w) <= 30}
                tally.update((w, False, y) for w in words)
                tally.update((s, True, y) for s in {w[:k] for w in words for k in STEMS if len(w) > k})
            yield pd.DataFrame([(t, s, n * (y == 1), n * (y != 1)) for (t, s, y), n in tally.items()], columns=["t", "s", "pos", "neg"])

    found = (
        sample.mapInPandas(count, "t string, s boolean, pos bigint, neg bigint")
        .groupBy("t", "s")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where((F.col("pos") >= MIN_DOCS) & (F.col("pos") * n_neg > F.col("neg") * n_pos * 8))
        .orderBy(F.col("pos").desc(), "t", "s")
        .limit(8 * MAX_TERMS)
        .collect()
    )
    terms, stems = choose_terms([(r.t, r.s, r.pos, r.neg) for r in found], n_pos, n_neg)
    counted = {(r.t, r.s): (r.pos, r.neg) for r in found}
    entries = [(t, False) for t in terms] + [(s, True) for s in stems]
    both = np.array([counted[e] for e in entries], dtype=float).reshape(-1, 2)
    exact = np.maximum(0, log_odds(both[:, 0], both[:, 1], n_pos, n_neg))
    draft = Model(Lexicon(terms, stems), exact, 0 * exact, Model.PRIOR)

    def misspelt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            tally: Counter = Counter()
            for text, y in zip(pdf["text"], pdf["y"]):
                tally.update((entry, y) for entry in {e for _, e, edits, _ in draft.hits(text) if edits})
            yield pd.DataFrame([(e, n * (y == 1), n * (y != 1)) for (e, y), n in tally.items()], columns=["entry", "pos", "neg"])

    near = np.zeros((len(entries), 2))
    for r in sample.mapInPandas(misspelt, "entry bigint, pos bigint, neg bigint").groupBy("entry").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).collect():
        near[r.entry] = r.p, r.n
    # unseen misspellings are taken to be as telling as two toxic texts against none
    near_weight = np.minimum(log_odds(near[:, 0] + 2, near[:, 1], max(n_pos, 1), max(n_neg, 1)), exact)
    near_weight = np.where(near_weight >= 1, near_weight, 0)
    model = Model(draft.lexicon, exact, near_weight, Model.PRIOR)

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"y": pdf["y"], "x": [model.features(t) for t in pdf["text"]]})

    rows = sample.mapInPandas(gather, "y int, x array<double>").toPandas()  # at most max_rows
    if n_pos and n_neg:
        model.weights = _fit_weights(np.stack(rows["x"]), (rows["y"] == 1).to_numpy(float), Model.PRIOR, Model.FIRM)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1), ``n_hits`` and ``n_misspelt``; columns of these names are replaced."""

    @F.pandas_udf("toxicity double, n_hits bigint, n_misspelt bigint")
    def rate(texts: pd.Series) -> pd.DataFrame:
        texts = [t or "" for t in texts]
        found = [model.hits(t) for t in texts]
        x = np.array([model.features(t, h) for t, h in zip(texts, found)]).reshape(len(texts), Model.N_FEATURES)
        return pd.DataFrame(
            {"toxicity": model.score(x), "n_hits": [len(h) for h in found], "n_misspelt": [sum(e > 0 for _, _, e, _ in h) for h in found]}
        )

    rated = docs.withColumn("_rated", rate(F.col(text_col)))
    return rated.withColumns({c: F.col(f"_rated.{c}") for c in ("toxicity", "n_hits", "n_misspelt")}).drop("_rated")
