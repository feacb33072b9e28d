"""Language identification: a linear-chain conditional random field labels every
word of a text, which may switch languages, by forward-backward.

Features of a word: affixes, all its character n-grams, and lexicon features
(words that are typical of a language in the training rows, by strength).  A
word of more than ``WIDTH - 2`` bytes (text without blanks is one) is cut into
consecutive pieces, each a position of the chain like a word.  Training
sequences are spliced from runs of words of different training documents, so
that the transitions learn how rarely the language changes.  The language of a
document is the one with the most posterior mass over its words with letters
(by pieces); the score is its share.

The model is fitted on a bounded sample (``DOCS_PER_LANGUAGE`` rows of each
language, by a hash of the id); whole texts are labelled.  Defined cases: null
text or text without a letter gives ``und`` with score 0, as does every text if
no training row exists; ties go to the first language by name; repeated rows
are labelled alike; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import crf
from .common import MAX_ONE_ROW_PER_PARTITION, bounded_broadcast, first_by_hash, mix64

DOCS_PER_LANGUAGE = 400
FEATURES = 1 << 16
LEXICON_FEATURES = 600  # three strengths of each language
LEXICON_SLOTS = 2       # lexicon features of a word
WIDTH = 32              # bytes of a word or a piece of one, with marks for its ends
GROUPS = (11, 17, WIDTH)  # words up to so many bytes are computed together
SEQUENCES = 6000
LENGTH = 32
STEPS = 400
LEXICON = 2000          # words of a language
CACHED_WORDS = 150_000
BATCH_WORDS = 300_000
UNKNOWN = "und"


def plain(word: str) -> str:
    """Letters of a word in lower case, without marks at its ends."""
    word = word.lower().strip(".,;:!?\"'()[]{}%&#$*|<>«»¿¡-_=")
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


def pieces(word: str) -> list[str]:
    """A plain word cut, between letters, into runs of at most WIDTH - 2 bytes."""
    most = WIDTH - 2
    if word.isascii():
        return [word[lo:lo + most] for lo in range(0, len(word), most)]
    sizes = [1 if c < "\x80" else 2 if c < "\u0800" else 3 if c < "\U00010000" else 4 for c in word]
    out, lo, size = [], 0, 0
    for at, n in enumerate(sizes):
        if size + n > most:
            out.append(word[lo:at])
            lo, size = at, 0
        size += n
    return [*out, word[lo:]] if word else []


def positions(text: str | None) -> tuple[list[str], int]:
    """The words of a text, long ones cut, and how many the cuts added."""
    words = (text or "").split()
    least = WIDTH - 2 if not text or text.isascii() else (WIDTH - 2) // 4  # no shorter word is cut
    if max(map(len, words), default=0) <= least:
        return words, 0
    out: list[str] = []
    for w in words:
        if len(w) > least and (len(w) > WIDTH - 2 or len(w.lower().encode("utf-8", "surrogatepass")) > WIDTH - 2):
            cut = pieces(plain(w))
            out += cut if len(cut) > 1 else [w]
        else:
            out.append(w)
    return out, len(out) - len(words)


def feature_rows(words: list[str], lexicon: dict[str, tuple[int, ...]]) -> np.ndarray:
    """Hashed features (a row per word, 0 for none) of plain words of at most
    WIDTH - 2 bytes: the word if short, affixes of two to four bytes, all
    bigrams and trigrams, all with marks for its ends, and its lexicon
    features.  Rows are as wide as the longest word needs."""
    raw = [b"^" + w.encode("utf-8", "surrogatepass") + b"$" for w in words]
    n = np.fromiter(map(len, raw), np.int64, len(raw))
    m = np.frombuffer(b"".join(x.ljust(WIDTH, b"\0") for x in raw), np.uint8).reshape(-1, WIDTH).astype(np.uint64)
    grams = max(0, int(n.max(initial=0)) - 1)
    out = np.zeros((len(raw), 7 + 2 * grams + LEXICON_SLOTS), np.int64)
    slot = 0

    def put(kind: int, code: np.ndarray, valid: np.ndarray) -> None:
        nonlocal slot
        h = mix64(code * np.uint64(64) + np.uint64(kind)) % np.uint64(FEATURES - 1 - LEXICON_FEATURES)
        out[:, slot] = np.where(valid, h.astype(np.int64) + 1, 0)
        slot += 1

    def gram(at: np.ndarray | int, k: int) -> np.ndarray:
        code = np.zeros(len(raw), np.uint64)
        for i in range(k):
            column = m[:, min(at + i, WIDTH - 1)] if isinstance(at, int) else m[np.arange(len(raw)), np.clip(at + i, 0, WIDTH - 1)]
            code = code * np.uint64(256) + column
        return code

    put(1, gram(0, 8), n <= 8)
    for k in (2, 3, 4):
        put(k, gram(0, k), n >= k)
        put(k + 8, gram(n - k, k), n >= k)
    for i in range(grams):
        put(20, gram(i, 2), n >= i + 2)
        put(21, gram(i, 3), n >= i + 3)
    for i in range(LEXICON_SLOTS):
        out[:, slot + i] = [f[i] if i < len(f) else 0 for f in map(lexicon.get, words, [()] * len(words))]
    return out


def _lexicon(counts: dict[str, Counter]) -> dict[str, tuple[int, ...]]:
    """By word: features that name its language and how typical it is."""
    total = {k: sum(c.values()) + 1 for k, c in counts.items()}
    everywhere: Counter = sum(counts.values(), Counter())
    out: dict[str, tuple[int, ...]] = {}
    for number, (k, c) in enumerate(sorted(counts.items())):
        rate = {w: (n / total[k]) / ((everywhere[w] - n + 0.5) / (sum(total.values()) - total[k] + 1))
                for w, n in c.items() if n >= 5}
        for w, r in sorted(rate.items(), key=lambda x: (-c[x[0]], x[0]))[:LEXICON]:
            if r > 4:
                place = (3 * number + min(2, int(np.log10(r)))) % LEXICON_FEATURES
                out[w] = (*out.get(w, ()), FEATURES - 1 - place)
    return out


def training_rows(docs: DataFrame, usable: Column, per_language: int = DOCS_PER_LANGUAGE) -> list:
    """(text, lang) of at most ``per_language`` rows of each language among
    those ``usable``, chosen by a hash of the id."""
    known = docs.where(usable & F.col("lang").isNotNull()).select("doc_id", "lang")
    ids = first_by_hash(known, per_language, ("lang",)).select("doc_id").distinct()
    rows = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    found = rows.join(bounded_broadcast(ids, MAX_ONE_ROW_PER_PARTITION), "doc_id").dropDuplicates(["doc_id"])
    return sorted((r["doc_id"], r["text"], r["lang"]) for r in found.collect())


def fit(rows: list) -> tuple[crf.Crf, dict] | None:
    """The model and its lexicon from (doc_id, text, lang) rows."""
    labels = sorted({r[2] for r in rows})
    docs = [([p for p in map(plain, positions(text)[0]) if p], labels.index(lang)) for _, text, lang in rows]
    docs = [d for d in docs if d[0]]
    if not docs:
        return None
    labels_seen = sorted({y for _, y in docs})
    counts = {labels[y]: Counter() for y in labels_seen}
    for words, y in docs:
        counts[labels[y]].update(words)
    lexicon = _lexicon(counts)
    by = {y: [w for w, z in docs if z == y] for y in labels_seen}
    rng = np.random.default_rng(11)
    index: dict[str, int] = {}
    x, truth = np.zeros((SEQUENCES, LENGTH), np.int64), np.zeros((SEQUENCES, LENGTH), np.int64)
    for i in range(SEQUENCES):
        at = 0
        while at < LENGTH:
            y = labels_seen[rng.integers(len(labels_seen))]
            words = by[y][rng.integers(len(by[y]))]
            n = min(LENGTH - at, len(words), int(rng.geometric(1 / 16)))
            lo = int(rng.integers(len(words) - n + 1))
            x[i, at:at + n] = [index.setdefault(w, len(index)) for w in words[lo:lo + n]]
            truth[i, at:at + n] = y
            at += n
    table = feature_rows(list(index), lexicon)
    return crf.train(table, x, truth, labels, FEATURES, STEPS), lexicon


class WordEmissions(dict):
    """Row of ``table`` that holds a word's emissions; row 0 is for words
    without letters.  ``learn`` the words of a text before looking them up;
    ``fresh`` between batches starts anew when the table is full."""

    def __init__(self, model: crf.Crf, lexicon: dict) -> None:
        super().__init__()
        self.model, self.lexicon = model, lexicon
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.table = np.zeros((1, len(self.model.labels)), np.float32)

    def learn(self, words: set[str]) -> None:
        new = list(words.difference(self))
        for lo in range(0, len(new), 20_000):
            part = new[lo:lo + 20_000]
            plains = [plain(w) for w in part]
            size = np.array([len(p.encode("utf-8", "surrogatepass")) + 2 for p in plains])
            rows = np.zeros((len(part), len(self.model.labels)), np.float32)
            for least, most in zip((0, *GROUPS), GROUPS):
                at = np.flatnonzero((size > least) & (size <= most))
                if len(at):
                    found = feature_rows([plains[k] for k in at], self.lexicon)
                    rows[at] = self.model.weights[found].sum(axis=1)
            at = iter(range(len(self.table), len(self.table) + len(part)))
            keep = np.array([bool(p) for p in plains])
            self.update((w, next(at) if p else 0) for w, p in zip(part, plains, strict=True))
            self.table = np.concatenate([self.table, rows[keep]])

    def fresh(self) -> None:
        if len(self) > CACHED_WORDS:
            self.clear()


def label_texts(texts: list, model: crf.Crf, emissions: WordEmissions) -> Iterator[tuple]:
    """(position, word rows, posteriors, positions that cuts added) of every
    text that has words."""
    held, size = [], 0
    for i, text in enumerate(texts):
        words, added = positions(text)
        held.append((i, words, added))
        size += len(words)
        if size >= BATCH_WORDS or i + 1 == len(texts):
            emissions.fresh()
            emissions.learn(set().union(*(w for _, w, _ in held)))
            ids = [np.fromiter(map(emissions.__getitem__, w), np.int64, len(w)) for _, w, _ in held]
            for part in crf.batches(np.array([len(x) for x in ids]), BATCH_WORDS):
                mine = [ids[j] for j in part]
                gamma = crf.posteriors(model, emissions.table, mine)
                for c, j in enumerate(part):
                    yield held[j][0], mine[c], gamma[:len(mine[c]), c], held[j][2]
            held, size = [], 0


def _predict(texts: list, model: crf.Crf | None, emissions: WordEmissions | None) -> tuple:
    """Languages, scores, words, switches and certainties (the mean of the
    words' best posteriors) of ``texts``."""
    n = len(texts)
    names, scores, sure = [UNKNOWN] * n, np.zeros(n), np.zeros(n)
    words, switches = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, rows, gamma, added in label_texts(texts, model, emissions) if model else ():
        gamma = gamma[rows > 0]
        if len(gamma):
            mass = gamma.sum(axis=0, dtype=np.float64)
            best = int(mass.argmax())
            names[i], scores[i] = model.labels[best], min(1.0, mass[best] / mass.sum())
            sure[i] = gamma.max(axis=1).mean(dtype=np.float64)
            top = gamma.argmax(axis=1)
            words[i], switches[i] = len(top) - added, int((top[1:] != top[:-1]).sum())
    return names, scores, words, switches, sure


def identify(docs: DataFrame, usable: Column) -> DataFrame:
    """(doc_id, lang_pred, score, n_words, n_switches) of every row of
    ``docs``; ``usable`` says which rows may be learnt from.  n_words are those
    with letters, n_switches the changes of the likeliest language between
    them and the pieces of long ones."""
    fitted = fit(training_rows(docs, usable))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, emissions = (fitted[0], WordEmissions(*fitted)) if fitted else (None, None)
        for batch in batches:
            names, *numbers, _ = _predict(batch.column(1).to_pylist(), model, emissions)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), *map(pa.array, numbers)],
                                             ["doc_id", "lang_pred", "score", "n_words", "n_switches"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, n_words long, n_switches long")


def accepted(docs: DataFrame, usable: Column, least: float = 0.5) -> DataFrame:
    """Rows of ``docs`` whose words' languages are known with a certainty of
    ``least`` or more, in however many languages, unchanged."""
    fitted, at = fit(training_rows(docs, usable)), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, emissions = (fitted[0], WordEmissions(*fitted)) if fitted else (None, None)
        for batch in batches:
            names, *_, sure = _predict(batch.column(at).to_pylist(), model, emissions)
            yield batch.filter(pa.array([x != UNKNOWN and s >= least for x, s in zip(names, sure, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
