"""Toxicity: Levenshtein automata intersected with a lexicon trie find abusive
terms, also misspelled; scores of their context windows tell abuse from
quotation.

The lexicon holds fixed terms and those that the labels single out.  All terms'
automata run at once on the trie: a state is a set of (trie node, edits), made
deterministic while it is used, so that most words leave it after a few
letters.  A term of fewer than five letters must match exactly, up to seven
letters allow one edit, longer ones two.  Each hit gets a score from its
distance, its term and a window of words around it (quotation marks, reporting
words, words that address someone, further hits); a document's score comes from
its hits' scores.  Both scores are logistic models.

Fitted on a bounded sample of labelled rows (``SAMPLE``, by a hash of the id);
whole texts are scored.  Defined cases: null text is empty; texts without a hit
get the chance that such texts have; without a labelled row of both kinds the
score is the share of label 1 (0.5 without any) for all; repeated rows score
alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, first_by_hash

SAMPLE = 6000          # labelled documents
WINDOW = 8             # words on each side
CACHED_WORDS = 300_000
MOST_TERMS = 200
LEAST_DOCS = 5         # documents with label 1 that a learnt term needs
LEAST_RATIO = 12.0     # how much oftener a learnt term is in them

# Terms, reporting words, words that address someone.
TERMS = ("idiot", "moron", "stupid", "loser", "scum", "pathetic", "worthless", "disgusting", "imbecile", "bastard")
REPORTING = frozenset("said says wrote called quote quoted quotes word term phrase reported alleged cited "
                      "sagte schrieb zitat wort dit écrit mot citation dijo escribió palabra cita".split())
ADDRESS = frozenset("you your you're u ur du dich ihr dein tu te vous votre tú usted ustedes vos".split())
QUOTES = "\"'“”„«»‘’`"
EDGES = ".,;:!?()[]{}%&#$*|<>-_=~" + QUOTES


def edits_of(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class TrieAutomaton:
    """The union of the Levenshtein automata of ``terms``, run on their trie."""

    def __init__(self, terms: list[str]) -> None:
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]
        self.most: list[int] = [0]  # edits that some term below a node allows
        for t, term in enumerate(terms):
            node, k = 0, edits_of(term)
            self.most[0] = max(self.most[0], k)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], k)
            if self.ends[node] < 0:
                self.ends[node] = t
        self.alphabet = {c for ch in self.children for c in ch}
        self.states: list[dict[int, int]] = []
        self.numbers: dict[tuple, int] = {}
        self.steps: list[dict[str, int]] = []
        self.accepts: list[tuple[int, int] | None] = []
        self.dead = self._state({})
        self.first = self._state({0: 0})

    def _state(self, positions: dict[int, int]) -> int:
        """Number of the state with these positions, closed under skipping
        letters of a term."""
        closed, todo = dict(positions), list(positions.items())
        while todo:
            node, e = todo.pop()
            if closed.get(node, 99) < e:
                continue
            for child in self.children[node].values():
                if e + 1 <= self.most[child] and closed.get(child, 99) > e + 1:
                    closed[child] = e + 1
                    todo.append((child, e + 1))
        key = tuple(sorted(closed.items()))
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(closed)
            self.steps.append({})
            ends = [(e, self.ends[n]) for n, e in closed.items()
                    if self.ends[n] >= 0 and e <= edits_of(self.terms[self.ends[n]])]
            self.accepts.append(min(ends) if ends else None)
        return self.numbers[key]

    def _step(self, state: int, c: str) -> int:
        out: dict[int, int] = {}

        def put(node: int, e: int) -> None:
            if e <= self.most[node] and out.get(node, 99) > e:
                out[node] = e

        for node, e in self.states[state].items():
            put(node, e + 1)  # a letter too many
            for letter, child in self.children[node].items():
                put(child, e + (letter != c))
        return self._state(out)

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the nearest term within its allowance, or None."""
        state = self.first
        for c in word:
            c = c if c in self.alphabet else ""
            steps = self.steps[state]
            if c not in steps:
                steps[c] = self._step(state, c)
            state = steps[c]
            if state == self.dead:
                return None
        return self.accepts[state]


class WordHits(dict):
    """By word: 0, or 1 + 3 * term + edits."""

    def __init__(self, automaton: TrieAutomaton) -> None:
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        found = self.automaton.match(word.lower().strip(EDGES))
        code = 0 if found is None else 1 + 3 * found[1] + found[0]
        if len(word) <= 40:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = code
        return code


@dataclass
class Logistic:
    """Logistic regression with a small ridge, by Newton steps."""
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def fit(self, x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> Logistic:
        x = np.concatenate([np.ones((len(x), 1)), x], 1)
        w = np.zeros(x.shape[1])
        pull = np.full(len(w), ridge)
        pull[0] = 1e-3
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            g = x.T @ (y - p) - pull * w
            step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(pull), g)
            w = w + np.clip(step, -3, 3)
            if np.abs(step).max() < 1e-6:
                break
        self.weights = w
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -30, 30)))


@dataclass
class Model:
    terms: list[str]
    odds: np.ndarray       # of each term
    window: Logistic
    document: Logistic
    constant: float | None = None


def plain_words(text: str) -> list[str]:
    return [w for w in (x.lower().strip(EDGES) for x in text.split()) if w]


def learn_terms(texts: list[str], y: np.ndarray) -> list[str]:
    """Words that occur in ``LEAST_DOCS`` texts of label 1 and ``LEAST_RATIO``
    times as often there as elsewhere, most telling first."""
    with_, without = Counter(), Counter()
    for t, k in zip(texts, y, strict=True):
        (with_ if k else without).update({w for w in plain_words(t) if 3 <= len(w) <= 30 and w.isalpha()})
    n, m = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    least = max(LEAST_DOCS, round(0.02 * n))
    ratio = {w: (c / n) / ((without[w] + 1) / m) for w, c in with_.items() if c >= least}
    return sorted((w for w, r in ratio.items() if r >= LEAST_RATIO), key=lambda w: (-ratio[w], w))[:MOST_TERMS]


def windows(words: list[str], codes: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Features of the hits of one text."""
    hits = np.flatnonzero(codes)
    out = np.zeros((len(hits), 9))
    for r, i in enumerate(hits.tolist()):
        term, edits = divmod(int(codes[i]) - 1, 3)
        before, after = words[max(0, i - WINDOW):i], words[i + 1:i + 1 + WINDOW]
        near = {w.lower().strip(EDGES) for w in (*before[-4:], *after[:4])}
        opened = any(w[0] in QUOTES for w in (*before, words[i]))
        closed = any(w.rstrip(".,;:!?")[-1:] in tuple(QUOTES) for w in (words[i], *after))
        told = bool(REPORTING & {w.lower().strip(EDGES) for w in before})
        around = np.count_nonzero(codes[max(0, i - WINDOW):i + 1 + WINDOW]) - 1
        out[r] = (edits == 0, edits == 1, edits == 2, odds[term], opened and closed, told, (opened and closed) and told,
                  bool(ADDRESS & near), min(3, around))
    return out


def document_features(scores: np.ndarray, feats: np.ndarray, n_words: int) -> list[float]:
    if not len(scores):
        return [0.0] * 5
    return [1.0, float(scores.max()), float(np.log1p(scores.sum())), float(feats[:, 4].mean()),
            float(np.log1p(100 * scores.sum() / max(20, n_words)))]


def fit(texts: list[str], y: np.ndarray) -> Model:
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        return Model(list(TERMS), np.zeros(len(TERMS)), Logistic(), Logistic(), share)
    terms = list(dict.fromkeys([*TERMS, *learn_terms(texts, y)]))
    hits = WordHits(TrieAutomaton(terms))
    split = [t.split() for t in texts]
    codes = [np.fromiter(map(hits.__getitem__, w), np.int64, len(w)) for w in split]
    seen = np.zeros((2, len(terms)))
    for c, k in zip(codes, y, strict=True):
        seen[int(k), np.unique((c[c > 0] - 1) // 3)] += 1
    odds = np.log((seen[1] + 0.5) / (y.sum() + 1)) - np.log((seen[0] + 0.5) / ((1 - y).sum() + 1))
    feats = [windows(w, c, odds) for w, c in zip(split, codes, strict=True)]
    x = np.concatenate(feats)
    window = Logistic()
    truth = np.repeat(y, [len(f) for f in feats])
    if 0 < truth.sum() < len(truth):
        window.fit(x, truth)
    else:
        window.weights = np.zeros(x.shape[1] + 1)
    rows = np.array([document_features(window.score(f), f, len(w)) for f, w in zip(feats, split, strict=True)])
    return Model(terms, odds, window, Logistic().fit(rows, y))


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, label: str) -> tuple[list[str], np.ndarray]:
    """Texts and labels of at most ``SAMPLE`` labelled documents."""
    known = labels.where(usable & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    ids = first_by_hash(known, SAMPLE)
    found = docs.select("doc_id", "text").join(bounded_broadcast(ids, SAMPLE), "doc_id").dropDuplicates(["doc_id"])
    rows = sorted((r["doc_id"], r["text"] or "", r["y"]) for r in found.collect())
    return [r[1] for r in rows], np.array([r[2] for r in rows], np.float64)


def classify(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic") -> DataFrame:
    """(doc_id, score, n_hits, n_misspelled, n_quoted) of every row of
    ``docs``."""
    model = fit(*training_rows(docs, labels, usable, label))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = WordHits(TrieAutomaton(model.terms))
        for batch in batches:
            rows, counts = [], []
            for text in batch.column(1):
                words = (text.as_py() or "").split()
                codes = np.fromiter(map(hits.__getitem__, words), np.int64, len(words))
                if model.constant is not None or not codes.any():
                    rows.append([0.0] * 5)
                    counts.append((0, 0, 0))
                    continue
                f = windows(words, codes, model.odds)
                rows.append(document_features(model.window.score(f), f, len(words)))
                counts.append((len(f), int((f[:, 0] == 0).sum()), int(f[:, 4].sum())))
            n = len(rows)
            score = (np.full(n, model.constant) if model.constant is not None
                     else model.document.score(np.array(rows).reshape(n, 5)))
            c = np.array(counts, np.int64).reshape(n, 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), *(pa.array(c[:, i].copy()) for i in range(3))],
                                             ["doc_id", "score", "n_hits", "n_misspelled", "n_quoted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, score double, n_hits long, n_misspelled long, n_quoted long")
