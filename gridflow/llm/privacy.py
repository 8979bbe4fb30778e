"""Personal data: exact patterns, and a linear-chain conditional random field beside them.

The patterns find e-mail addresses, IP addresses, card numbers and international phone numbers; per kind
the leftmost non-overlapping matches count, and those that fail their check are dropped. The field adds
what has no pattern: names, street addresses, local or spelled-out contacts, and document numbers. Its
features are the shapes of words (case, length, digits, glued or not, repeated or not) and the words known from
training, both from two places before to two after; its labels have weights for each pair of neighbours. It is fitted on a
small labelled table (at most ``TRAIN_ROWS`` rows) and decoded by Viterbi in numpy batches. Added spans that
touch a pattern's span are dropped, so pattern spans stay as they are.

Decoding skips nothing: a word is set to "none" beforehand only where no choice of labels around it could
prefer another label (a bound from the weights); what lies between such words is decoded exactly.

Spans are code point offsets, end exclusive. A sequence is a line; lines longer than ``PIECE`` code points
are several sequences, cut at blanks. A null text counts as empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflow.llm.common import _BASE, _INVERSE, _powers, mix, small_batches

U64 = np.uint64
# fixed values: kinds in the order in which spans are listed
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("person", "address", "contact", "number")
KINDS = BASE_KINDS + ADDED_KINDS
LABELS = ("none",) + ADDED_KINDS
K = len(LABELS)

# fixed values: the patterns, written so that no text takes more than linear time
LOCAL_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?+[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS = (13, 19)
PHONE_DIGITS = (9, 15)

REACH = 2             # places to either side whose features count
TRAIN_ROWS = 2000     # labelled rows used, at most
LEAST_WORD = 3        # occurrences of a word that gets weights of its own
STEPS = 120
RATE = 0.15
RIDGE = 0.02
PIECE = 1 << 20       # code points taken at once
LONG_WORD, LONG_NUMBER = 8, 20  # lengths from here on are one shape


# ---------------------------------------------------------------- patterns

def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in DOMAIN.finditer(text):
        at = m.start()
        least = max(done, text.rfind("@", done, at) + 1)
        start = least + len(text[least:at].rstrip(LOCAL_CHARS))
        if start < at:
            yield start, m.end()
            done = m.end()


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' matches, by kind, then start."""
    out = [("email", s, e) for s, e in _emails(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text)
            if m.end() - m.start() <= 2 * CARD_DIGITS[1] and CARD_DIGITS[0] <= len(d := _digits(m[0])) <= CARD_DIGITS[1] and luhn(d)]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if PHONE_DIGITS[0] <= len(_digits(m[0])) <= PHONE_DIGITS[1]]
    return out


# ---------------------------------------------------------------- words and their features

# by code point of the first plane; characters beyond it count as letters without case
_BLANK, _DIGIT, _LETTER, _SIGN = 0, 1, 2, 3
_GROUP = np.array([_BLANK if c.isspace() else _DIGIT if "0" <= c <= "9" else _LETTER if c.isalpha() else _SIGN for c in map(chr, range(1 << 16))], dtype=np.uint8)
_UPPER = np.array([c.isupper() for c in map(chr, range(1 << 16))])
_LOWER = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in map(chr, range(1 << 16))], dtype=np.uint32)
_FORMS = 4 * LONG_WORD
SHAPES = 4 * (_FORMS + LONG_NUMBER + 1) + 1  # the last is that of a place outside the line


@dataclass
class Words:
    """Words of a text, line after line. ``place`` is each word's index in an array in which ``REACH``
    places lie before, between and behind the lines."""

    start: np.ndarray
    end: np.ndarray
    shape: np.ndarray
    hash: np.ndarray   # of the lower-cased word; 0 for a number
    place: np.ndarray
    places: int

    def spread(self, values: np.ndarray, outside: int) -> np.ndarray:
        out = np.full(self.places, outside, dtype=np.int64)
        out[self.place] = values
        return out


def words_of(text: str) -> Words:
    """Runs of letters, runs of the digits 0-9, and all other characters but blanks one by one."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = np.minimum(c, 0xFFFF)
    group = _GROUP[low]
    beyond = c > 0xFFFF
    if beyond.any():
        group[beyond] = _LETTER
    change = np.empty(len(c) + 1, dtype=bool)
    change[[0, -1]] = True
    if len(c):
        change[1:-1] = (group[1:] != group[:-1]) | (group[1:] == _SIGN)
    bounds = np.flatnonzero(change)
    start, end = bounds[:-1], bounds[1:]
    keep = group[start] != _BLANK if len(c) else np.zeros(0, dtype=bool)
    start, end = start[keep], end[keep]
    kind, size = group[start], end - start

    upper = np.zeros(len(c) + 1, dtype=np.int32)
    np.cumsum(_UPPER[low] & ~beyond, out=upper[1:])
    capitals = upper[end] - upper[start]
    form = np.select([capitals == 0, capitals == size, (capitals == 1) & (upper[start + 1] > upper[start])], [0, 2, 1], 3)
    shape = np.select([kind == _LETTER, kind == _DIGIT],
                      [form * LONG_WORD + np.minimum(size, LONG_WORD) - 1, _FORMS + np.minimum(size, LONG_NUMBER) - 1], _FORMS + LONG_NUMBER)
    glued = np.zeros(len(start), dtype=bool)
    glued[1:] = start[1:] == end[:-1]

    lowered = np.where(beyond, c, _LOWER[low]).astype(U64) + U64(1)
    total = np.zeros(len(c) + 1, dtype=U64)
    np.cumsum(lowered * _powers(_BASE, len(c)), out=total[1:])
    h = mix((total[end] - total[start]) * _powers(_INVERSE, len(c) + 1)[start])
    again = np.zeros(len(start), dtype=bool)  # a word next to itself
    again[1:] = (h[1:] == h[:-1]) & (kind[1:] == _LETTER)
    again[:-1] |= again[1:]
    h[kind == _DIGIT] = 0

    lines = np.zeros(len(c) + 1, dtype=np.int64)
    np.cumsum(c == 10, out=lines[1:])
    line = lines[start]
    line = np.cumsum(np.diff(line, prepend=line[:1]) > 0)  # lines without words do not count
    place = np.arange(len(start)) + REACH * (line + 1)
    return Words(start, end, 4 * shape + 2 * again + glued, h, place, int(place[-1]) + 1 + REACH if len(place) else 2 * REACH)


# ---------------------------------------------------------------- the model

def _moved(ids: np.ndarray, by: int, outside: int) -> np.ndarray:
    """The feature at place + ``by``, for every place."""
    out = np.full_like(ids, outside)
    if by < 0:
        out[-by:] = ids[:by]
    elif by:
        out[:-by] = ids[by:]
    else:
        out[:] = ids
    return out


@dataclass
class Field:
    """Weights: of words and of shapes by distance, feature and label, and of neighbouring labels.
    Places outside a line have the label none."""

    vocabulary: np.ndarray  # hashes, ascending
    word: np.ndarray        # (2 * REACH + 1, len(vocabulary) + 2, K): unknown words and outside come last
    shape: np.ndarray       # (2 * REACH + 1, SHAPES, K)
    turn: np.ndarray        # (K, K)

    def ids(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.vocabulary)
        at = np.searchsorted(self.vocabulary, w.hash)
        known = at < n
        known[known] = self.vocabulary[at[known]] == w.hash[known]
        return w.spread(np.where(known, at, n), n + 1), w.spread(w.shape, SHAPES - 1)

    def emissions(self, words: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        """Score of each label at each place from the features around it."""
        out = np.zeros((len(words), K))
        for i, by in enumerate(range(-REACH, REACH + 1)):
            out += self.word[i][_moved(words, by, len(self.vocabulary) + 1)]
            out += self.shape[i][_moved(shapes, by, SHAPES - 1)]
        return out

    def slack(self) -> np.ndarray:
        """By label: the least that replacing it by none can gain in its two turns, whatever the neighbours."""
        t = self.turn
        return (t[:, :1] - t).min(axis=0) + (t[:1, :] - t).min(axis=1)

    def labels(self, w: Words) -> np.ndarray:
        """The best label sequence of every line: one label per word."""
        if not len(w.start):
            return np.zeros(0, dtype=np.int64)
        e = self.emissions(*self.ids(w))
        settled = (e[:, :1] - e[:, 1:] + self.slack()[1:] > 0).all(axis=1)
        inside = np.zeros(w.places, dtype=bool)
        inside[w.place] = True
        found = np.zeros(w.places, dtype=np.int64)
        open_ = inside & ~settled
        edge = np.diff(open_.astype(np.int8), prepend=0, append=0)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        viterbi(e, self.turn, first, last - first, found)
        return found[w.place]


def viterbi(e: np.ndarray, turn: np.ndarray, first: np.ndarray, length: np.ndarray, out: np.ndarray) -> None:
    """Best labels of stretches e[first : first + length] between two places labelled none, written to
    ``out`` at their places. All stretches take a step together; those that have ended drop out."""
    if not len(first):
        return
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    going = np.searchsorted(-length, -np.arange(length[0]), side="left")  # stretches longer than t
    score = turn[0] + e[first]
    back = []
    for t in range(1, length[0]):
        n = going[t]
        paths = score[:n, :, None] + turn
        back.append(paths.argmax(axis=1).astype(np.int8))
        score[:n] = paths.max(axis=1) + e[first[:n] + t]
    label = (score + turn[:, 0]).argmax(axis=1)
    out[first + length - 1] = label
    for t in range(length[0] - 1, 0, -1):
        n = going[t]
        label[:n] = back[t - 1][np.arange(n), label[:n]]
        out[first[:n] + t - 1] = label[:n]


def likelihood(e: np.ndarray, turn: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Sum of the log partition functions of stretches, and its derivatives by ``e`` (the labels'
    probabilities) and by ``turn`` (the expected turns). Forward and backward sums, scaled at each step."""
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    going = np.searchsorted(-length, -np.arange(length[0]), side="left")
    top = e.max(axis=1, keepdims=True)
    x, t_ = np.exp(e - top), np.exp(turn)
    ahead, scale = np.zeros_like(e), np.ones(len(e))
    for t in range(length[0]):
        at = first[:going[t]] + t
        ahead[at] = (ahead[at - 1] @ t_ if t else t_[0]) * x[at]
        scale[at] = ahead[at].sum(axis=1)
        ahead[at] /= scale[at, None]
    last = first + length - 1
    end = (ahead[last] * t_[:, 0]).sum(axis=1)
    total = np.log(end).sum() + sum(np.log(scale[f:f + n]).sum() + top[f:f + n].sum() for f, n in zip(first, length))
    behind, turns = np.zeros_like(e), np.zeros_like(turn)
    behind[last] = t_[:, 0] / end[:, None]
    for t in range(length[0] - 1, 0, -1):
        at = first[:going[t]] + t
        y = x[at] * behind[at] / scale[at, None]
        turns += (ahead[at - 1].T @ y) * t_
        behind[at - 1] = y @ t_.T
    p = ahead * behind
    turns[0] += p[first].sum(axis=0)
    turns[:, 0] += p[last].sum(axis=0)
    return total, p, turns


def fit(rows: list[tuple[str, list[tuple[str, int, int]]]], steps: int = STEPS) -> Field:
    """From texts of one line each and their spans (kind, start, end): the maximum of the likelihood with
    a ridge penalty, by Adam on all rows. Words within a span get its label; unknown kinds get none."""
    text = "\n".join(t.replace("\n", " ") for t, _ in rows)
    at = np.cumsum([0] + [len(t) + 1 for t, _ in rows])
    w = words_of(text)
    label = np.zeros(len(text) + 1, dtype=np.int64)
    for base, (_, spans) in zip(at, rows):
        for kind, s, e in spans:
            if kind in LABELS:
                label[base + s:base + e] = LABELS.index(kind)
    h, n = np.unique(w.hash, return_counts=True)
    m = Field(h[(n >= LEAST_WORD) & (h != 0)], np.empty(0), np.zeros((2 * REACH + 1, SHAPES, K)), np.zeros((K, K)))
    m.word = np.zeros((2 * REACH + 1, len(m.vocabulary) + 2, K))
    if not len(w.start):
        return m
    words, shapes = m.ids(w)
    inside = np.zeros(w.places, dtype=bool)
    inside[w.place] = True
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    first = np.flatnonzero(edge == 1)
    length = np.flatnonzero(edge == -1) - first
    y = w.spread(label[w.start], 0)
    seen = np.zeros((w.places, K))
    seen[w.place, y[w.place]] = 1
    turns = np.bincount(K * y[:-1] + y[1:], weights=(inside[:-1] | inside[1:]).astype(float), minlength=K * K).reshape(K, K)
    tables = [(m.word[i], _moved(words, by, m.word.shape[1] - 1)) for i, by in enumerate(range(-REACH, REACH + 1))]
    tables += [(m.shape[i], _moved(shapes, by, SHAPES - 1)) for i, by in enumerate(range(-REACH, REACH + 1))]
    params = [t for t, _ in tables] + [m.turn]
    mean, spread = ([np.zeros_like(p) for p in params] for _ in range(2))
    for step in range(1, steps + 1):
        _, p, expected = likelihood(m.emissions(words, shapes), m.turn, first, length)
        off = np.where(inside[:, None], p - seen, 0)
        grads = [np.stack([np.bincount(ids, weights=off[:, k], minlength=len(t)) for k in range(K)], axis=1) for t, ids in tables]
        grads.append(expected - turns)
        for x, g, a, b in zip(params, grads, mean, spread):
            g = g + RIDGE * x
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            x -= RATE * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    return m


def added_spans(text: str, field: Field) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the runs of words with one label in a line, by start."""
    w = words_of(text)
    y = field.labels(w)
    if not y.any():
        return []
    new = np.ones(len(y), dtype=bool)
    new[1:] = (y[1:] != y[:-1]) | (np.diff(w.place) > 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(y)) - 1
    return [(LABELS[y[a]], int(w.start[a]), int(w.end[b])) for a, b in zip(first, last) if y[a]]


def pieces(text: str) -> Iterator[tuple[int, str]]:
    """(offset, piece): ``text`` cut behind line ends, or behind blanks where a line is too long, or anywhere."""
    at = 0
    while len(text) - at > PIECE:
        to = text.rfind("\n", at, at + PIECE) + 1 or text.rfind(" ", at, at + PIECE) + 1 or at + PIECE
        yield at, text[at:to]
        at = to
    yield at, text[at:]


def spans(texts: list[str], field: Field) -> list[list[tuple[str, int, int]]]:
    """All spans of each text: by kind in the order of ``KINDS``, then by start."""
    out = [base_spans(t) for t in texts]
    work = [(i, at, piece) for i, t in enumerate(texts) for at, piece in pieces(t)]
    while work:
        n, size = 0, 0  # short texts are taken together
        while n < len(work) and (not n or size + len(work[n][2]) <= PIECE):
            size += len(work[n][2]) + 1
            n += 1
        some, work = work[:n], work[n:]
        begin = np.cumsum([0] + [len(p) + 1 for _, _, p in some])
        for kind, s, e in added_spans("\n".join(p for _, _, p in some), field):
            k = int(np.searchsorted(begin, s, side="right")) - 1
            i, at, _ = some[k]
            out[i].append((kind, int(s - begin[k] + at), int(e - begin[k] + at)))
    for i, found in enumerate(out):
        if any(k not in BASE_KINDS for k, _, _ in found):
            base = sorted((s, e) for k, s, e in found if k in BASE_KINDS)
            found = [x for x in found if x[0] in BASE_KINDS or not any(s < x[2] and x[1] < e for s, e in base)]
            out[i] = sorted(found, key=lambda x: (KINDS.index(x[0]), x[1]))
    return out


# ---------------------------------------------------------------- tables

def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> Field:
    """Fit on at most ``rows`` rows (text, spans array<struct<kind,start,end>>) of a labelled table, those
    with the least hash; null texts and null spans count as empty."""
    some = labelled.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("spans", F.array()).alias("spans")) \
        .orderBy(F.xxhash64("text"), "text", "spans").limit(rows).collect()
    return fit([(r.text, [(s.kind, s.start, s.end) for s in r.spans if s is not None and None not in tuple(s)]) for r in some])


def scanned(docs: DataFrame, field: Field, text_col: str = "text", out: str = "private") -> DataFrame:
    """Adds ``out``: array of struct(kind, start, end). All rows and columns of ``docs`` stay."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = spans([x or "" for x in texts.to_pylist()], shared.value)
            yield pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in found], kind)

    return docs.withColumn(out, F.arrow_udf(run, "array<struct<kind:string,start:long,end:long>>")(F.col(text_col)))


def digest(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_email, n_ip, n_card, n_phone, base_sha256, spans (all, as text)."""
    found = scanned(docs.select(id_col, text_col), train(labelled), text_col, "s")
    words = lambda c: F.concat_ws(",", F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
    base = F.filter("s", lambda x: x["kind"].isin(*BASE_KINDS))
    count = lambda k: F.size(F.filter("s", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(id_col, *[count(k) for k in BASE_KINDS], F.sha2(words(base), 256).alias("base_sha256"), words(F.col("s")).alias("spans"))
