"""Personal data: fixed patterns, and a linear-chain conditional random field
over word shapes that adds what the patterns miss.

Base spans are the four patterns (mail address, network address, card number,
phone number), leftmost and without overlap within a kind, matches that fail a
kind's test being dropped.  The field is trained from the small labelled table
``LABELLED`` (digits drawn anew a few times) and decoded by Viterbi over batches
of numpy arrays.  It sees tokens (runs of letters, runs of digits, single
marks) of every stretch of a text around a digit, an at sign or a spelled-out
mark ("(at)", "[dot]"), without one of which no span passes its kind's test.  A
stretch grows until its first and last label are "no" (or the text ends);
beyond, the label is held at "no".  Spans are kept if they pass the kind's test
and touch no base span.

Defined cases: null and empty text have no span; texts of any length are read
whole, in time that grows with their length; repeated rows are read alike; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import crf

KINDS = ("email", "ip", "card", "phone")
FEATURES = 1 << 13
SLOTS = 16
ROUNDS = 12       # times that the labelled table is used, with other digits
STEPS = 300
BATCH_TOKENS = 200_000
PIECE_TOKENS = 4_000  # whose features are held at once
CACHED = 100_000
NEVER = -1e6      # log weight of a move that no labelling has
CONTEXT = 3       # chunks beside a mark that are decoded at first
LABELS = ["no", *(f"{b}-{k}" for k in KINDS for b in "bi")]

# The labelled table: [kind text] marks a span.
LABELLED = """
write to [email anna.berg@mail.example.org] before noon
contact [email j_doe42@lists.example.com] or [email office@example.net] today
mail [email lee (at) example (dot) com] for the keys
her address is [email r.smith [at] post [dot] example [dot] org] since May
send it to [email max@localhost] please
the user @handle posted 14 replies
server [ip 10.20.30.40] did not answer
from [ip 192.168.7.254] to [ip 172.16.5.9] in 12 hops
version 4.10.2 of the tool was released in 2021
section 3.2.1 and table 4.5 of chapter 12
build 10.4.300.999 failed twice
card [card 4111 1111 1111 1111] expires 09/27
pay with [card 5500-0000-0000-0004] or cash
number [card 340000000000009] was charged 25.00 euro
charged to [card 4012888888881881] [card 6011111111111117] on Monday
order 1234567 of 3 items at 19.99 each
invoice 2020-00017 dated 2020-11-30 over 1,250.00
call [phone +1 (415) 555-0134] at 9 or 10
call [phone (415) 555-0134] at 9
phone [phone 415-555-0199] or fax [phone 415-555-0142]
tel [phone 020 7946 0958] between 9 and 5
ring [phone +44 20 7946 0018] after 17:30
reach me on [phone 555.010.4477] or by [email kim@example.org]
mobile [phone 0151 23456789] and [phone +49 30 901820]
the years 1914 to 1918 and 1939 to 1945
in 2019 there were 100 000 of them , 12 percent
at 12:30 on 01.02.2023 we met 4 people
token = " 9f86d081884c7d659a2feaa0c55ad015 " is not for you
sha 2cf24dba5fb0a30e26e83b2ac5b9e29e1b161e5c and id 550e8400
1 . 2 . 3 . 4 . and so on
room 101 , floor 3 , seat 17-22
temperature 36.6 and pressure 1013.25
isbn 978-3-16-148410-0 page 42
a score of 3-2 , 15-13 and 21-19
"""

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_GROUPS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
_HOT = re.compile(r"[0-9@]")
_MARK = re.compile(r"[0-9@(\[](?:(?<=[0-9@])|\s*(?:[aA][tT]|[dD][oO][tT])\s*[)\]])")
_CHUNK = re.compile(r"\S+|\s+\S+")


def luhn(digits: str) -> bool:
    """Every second digit from the right counts double (less nine above nine)."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def is_card(text: str) -> bool:
    d = digits_of(text)
    return 12 <= len(d) <= 19 and luhn(d)


def is_phone(text: str) -> bool:
    return 9 <= len(digits_of(text)) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """At every at sign: the run of name characters before it, back to the last
    match, and the domain after it."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        else:
            last = max(last, at)  # a name never holds an at sign
        at = text.find("@", max(at + 1, last))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Runs of dotted numbers, taken four numbers at a time."""
    if "." not in text:
        return
    for m in _GROUPS.finditer(text):
        parts = m.group().split(".")
        at = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                yield at, end
            at = end + 1


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns by start, then kind."""
    if not _HOT.search(text):
        return []
    out = [("email", s, e) for s, e in _emails(text)]
    out += [("ip", s, e) for s, e in _ips(text)]
    out += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if len(m.group()) >= 12 and is_card(m.group())]
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if is_phone(m.group())]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def tokens(text: str, lo: int, hi: int) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text, lo, hi)]


def _shape(t: str) -> str:
    if t.isdecimal():
        return f"9{min(len(t), 20)}"
    return ("a" if t.islower() else "A" if t.isupper() else "Aa") + str(min(len(t), 5)) if t.isalpha() else t


def _token_features(t: str) -> tuple[str, ...]:
    low = t.lower()
    out = [_shape(t), "9" if t.isdecimal() else "a" if t.isalpha() else "m"]
    if t.isalpha() and len(t) < 8:
        out.append(f"w{low}")
    if t.isdecimal() and len(t) <= 3:
        out.append("<256" if int(t) < 256 else ">255")
    return tuple(out)


class Hashed(dict):
    """Hashed features by (place, name); starts anew when large."""

    def __missing__(self, key: tuple[int, str]) -> int:
        if len(self) >= CACHED:
            self.clear()
        out = self[key] = crc32(f"{key[0]} {key[1]}".encode("utf-8", "surrogatepass")) % (FEATURES - 1) + 1
        return out


def features(text: str, spans: list[tuple[int, int]], hashed: Hashed) -> np.ndarray:
    """Hashed features: a token's own and those of two neighbours each side, and
    whether white space stands before it."""
    own = [_token_features(text[s:e]) for s, e in spans]
    out = np.zeros((len(own), SLOTS), np.int64)
    for i in range(len(own)):
        f = [hashed[0, x] for x in own[i]]
        for place in (-2, -1, 1, 2):
            j = i + place
            f += [hashed[place, x] for x in (own[j][:3] if abs(place) == 1 else own[j][:1])] if 0 <= j < len(own) else [
                hashed[place, "edge"]]
        glued = i > 0 and spans[i - 1][1] == spans[i][0]
        follows = i + 1 < len(own) and spans[i + 1][0] == spans[i][1]
        f.append(hashed[9, f"{glued}{follows}{own[i][1]}"])
        out[i, :min(SLOTS, len(f))] = f[:SLOTS]
    return out


def spans_of_tokens(text: str, lo: int, hi: int) -> np.ndarray:
    """``tokens`` as an array: start, end."""
    return np.fromiter(chain.from_iterable(m.span() for m in _TOKEN.finditer(text, lo, hi)), np.int64).reshape(-1, 2)


def emissions(text: str, spans: np.ndarray, model: crf.Crf, hashed: Hashed) -> np.ndarray:
    """Summed weights of every token, a piece at a time with the two neighbours
    on each side that its features see."""
    out = np.empty((len(spans), len(model.labels)), model.weights.dtype)
    for lo in range(0, len(spans), PIECE_TOKENS):
        a, hi = max(0, lo - 2), min(len(spans), lo + PIECE_TOKENS)
        f = features(text, spans[a:hi + 2].tolist(), hashed)[lo - a:hi - a]
        out[lo:hi] = model.weights[f].sum(axis=1)
    return out


def parse_labelled(line: str) -> tuple[str, list[tuple[str, int, int]]]:
    """Text and spans of a line of the table."""
    text, spans, at = "", [], 0
    for m in re.finditer(r"\[(email|ip|card|phone) ((?:[^\[\]]|\[(?:at|dot)\])*)\]", line):
        text += line[at:m.start()]
        spans.append((m[1], len(text), len(text) + len(m[2])))
        text, at = text + m[2], m.end()
    return text + line[at:], spans


def fit(seed: int = 5) -> crf.Crf:
    rng, hashed = np.random.default_rng(seed), Hashed()
    rows, truth = [], []
    for r in range(ROUNDS):
        for line in LABELLED.strip().split("\n"):
            text, spans = parse_labelled(line)
            if r:  # other digits; parts of a network address stay below 256
                ips = [(s, e) for k, s, e in spans if k == "ip"]
                text = "".join(str(rng.integers(10)) if c.isdigit() and not any(s <= i < e for s, e in ips) else c
                               for i, c in enumerate(text))
            toks = tokens(text, 0, len(text))
            y = []
            for s, e in toks:
                hit = next(((k, a) for k, a, b in spans if a <= s and e <= b), None)
                y.append(LABELS.index(f"{'b' if hit[1] == s else 'i'}-{hit[0]}") if hit else 0)
            rows.append(features(text, toks, hashed))
            truth.append(y)
    longest = max(map(len, rows))
    table, x = [np.zeros((1, SLOTS), np.int64)], np.zeros((len(rows), longest), np.int64)
    y, at = np.zeros((len(rows), longest), np.int64), 1
    for i, f in enumerate(rows):
        x[i, :len(f)] = np.arange(at, at + len(f))
        y[i, :len(f)] = truth[i]
        table.append(f)
        at += len(f)
    model = crf.train(np.concatenate(table), x, y, LABELS, FEATURES, STEPS, rate=0.2, seed=seed)
    # a span goes on only with its own kind
    goes_on = np.array([k.startswith("i-") for k in LABELS])
    same = np.array([[a[2:] == b[2:] for b in LABELS] for a in LABELS])
    model.moves[goes_on & ~same] = NEVER
    model.start[goes_on] = NEVER
    return model


def _widened(text: str, lo: int, hi: int, before: int, after: int) -> tuple[int, int]:
    """The stretch from ``lo`` to ``hi`` with its first and last chunk whole and
    so many white-space separated chunks more on each side."""
    while lo > 0 and not text[lo - 1].isspace():
        lo -= 1
    for _ in range(before):
        at = lo
        while at > 0 and text[at - 1].isspace():
            at -= 1
        if not at:
            break
        lo = at
        while lo > 0 and not text[lo - 1].isspace():
            lo -= 1
    for _ in range(after + 1):
        m = _CHUNK.match(text, hi)
        if not m:
            break
        hi = m.end()
    return lo, hi


def islands(text: str) -> list[tuple[int, int]]:
    """Stretches of white-space separated chunks around every digit, at sign and
    spelled-out mark, with ``CONTEXT`` chunks more on each side."""
    out: list[tuple[int, int]] = []
    m = _MARK.search(text)
    while m:
        lo, own = _widened(text, m.start(), m.end(), CONTEXT, 0)
        hi = _widened(text, own, own, 0, CONTEXT)[1]
        if out and lo <= out[-1][1]:
            out[-1] = out[-1][0], hi
        else:
            out.append((lo, hi))
        m = _MARK.search(text, own)
    return out


_AT = re.compile(r"@|[(\[]\s*at\s*[)\]]", re.I)


def _sound(kind: str, part: str) -> bool:
    """The kind's test for a span that the field found."""
    d = digits_of(part)
    if kind == "card":
        return is_card(part)
    if kind == "ip":
        groups = re.findall("[0-9]+", part)
        return len(groups) == 4 and all(int(g) <= 255 for g in groups if len(g) < 9) and max(map(len, groups)) < 9
    if kind == "phone":
        return 9 <= len(d) <= 15 and not re.search(r"[^0-9+(). /-]", part) and bool(re.search(r"[^0-9]", part))
    m = _AT.search(part)
    return bool(m) and len(part) >= 5 and bool(part[:m.start()].strip()) and bool(part[m.end():].strip())


def _decoded(texts: list[str], todo: list, model: crf.Crf, hashed: Hashed) -> Iterator[tuple]:
    """((text number, start, end), tokens, labels) of the islands ``todo``.  A
    token takes some hundred bytes, however long its island is."""
    held: list[tuple] = []
    size = 0
    for n, island in enumerate(todo, 1):
        i, lo, hi = island
        toks = spans_of_tokens(texts[i], lo, hi)
        held.append((island, toks, emissions(texts[i], toks, model, hashed)))
        size += len(toks)
        if size > BATCH_TOKENS or n == len(todo):
            for part in crf.batches(np.array([len(h[1]) for h in held]), BATCH_TOKENS):
                found = crf.viterbi(model, [held[k][2] for k in part])
                for j, y in zip(part, found, strict=True):
                    yield held[j][0], held[j][1], y
            held.clear()
            size = 0


def found_spans(texts: list[str], base: list[list], model: crf.Crf, hashed: Hashed) -> list[list]:
    """Spans that the field adds to ``base``, by text.  An island whose labels
    run to its edge is decoded again with more of the text on that side, and
    together with the islands that it then meets."""
    done: list[dict] = [{} for _ in texts]  # spans by island
    todo = [(i, lo, hi) for i, text in enumerate(texts) for lo, hi in islands(text)]
    while todo:
        wider: dict[int, list] = {}
        for (i, lo, hi), toks, y in _decoded(texts, todo, model, hashed):
            if y[0] or y[-1]:
                n = len(toks)
                new = _widened(texts[i], lo, hi, n if y[0] else 0, n if y[-1] else -1)
                if new != (lo, hi):
                    wider.setdefault(i, []).append(new)
                    continue
            spans = done[i][lo, hi] = []
            at = 0
            while at < len(y):
                if not y[at]:
                    at += 1
                    continue
                kind, end = LABELS[y[at]][2:], at + 1
                while end < len(y) and LABELS[y[end]] == f"i-{kind}":
                    end += 1
                s, e = int(toks[at, 0]), int(toks[end - 1, 1])
                if _sound(kind, texts[i][s:e]) and all(e <= a or b <= s for _, a, b in base[i]):
                    spans.append((kind, s, e))
                at = end
        todo = []
        for i, new in wider.items():
            merged: list[tuple[int, int]] = []
            for lo, hi in sorted([*new, *done[i]]):
                if merged and lo <= merged[-1][1]:
                    merged[-1] = merged[-1][0], max(hi, merged[-1][1])
                else:
                    merged.append((lo, hi))
            done[i] = {x: done[i][x] for x in merged if x in done[i]}
            todo += [(i, *x) for x in merged if x not in done[i]]
    return [[x for spans in d.values() for x in spans] for d in done]


def digest(spans: list) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan(texts: list, model: crf.Crf, hashed: Hashed) -> Iterator[tuple[list, list]]:
    """(base spans, all spans) of every text."""
    texts = [t or "" for t in texts]
    base = [base_spans(t) for t in texts]
    for b, f in zip(base, found_spans(texts, base, model, hashed), strict=True):
        yield b, sorted(b + f, key=lambda x: (x[1], KINDS.index(x[0])))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans); the counts
    are of base spans, positions are code points, ends exclusive."""
    model = fit()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Hashed()
        for batch in batches:
            rows = []
            for lo in range(0, batch.num_rows, 1000):
                for b, every in scan(batch.column(1)[lo:lo + 1000].to_pylist(), model, hashed):
                    kinds = [k for k, _, _ in b]
                    rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(digest(b).encode()).hexdigest(), digest(every)))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]),
                                              *(pa.array(c, pa.string()) for c in cols[4:])], names)

    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def masked(text: str, spans: list) -> str:
    """``text`` with every span (joined where they overlap) replaced by its
    kind in angle brackets."""
    out, at = [], 0
    for k, s, e in spans:
        if s >= at:
            out += [text[at:s], f"<{k}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in ``text`` and ``n_chars`` renewed;
    all other columns and all rows stay."""
    model, order = fit(), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Hashed()
        t, n = order.index("text"), order.index("n_chars") if "n_chars" in order else -1
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                texts = part.column(t).to_pylist()
                new = [x if x is None or not s else masked(x, s)
                       for x, (_, s) in zip(texts, scan(texts, model, hashed), strict=True)]
                cols = list(part.columns)
                cols[t] = pa.array(new, cols[t].type)
                if n >= 0:
                    sizes = [None if x is None else len(x) for x in new]
                    changed = [a if x == y else b for x, y, a, b in zip(texts, new, cols[n].to_pylist(), sizes, strict=True)]
                    cols[n] = pa.array(changed, cols[n].type)
                yield pa.RecordBatch.from_arrays(cols, names=order)

    return docs.mapInArrow(run, docs.schema)
