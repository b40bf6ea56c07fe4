"""Toxicity behind disguises: a noisy channel is undone, then the restored text is scored.

* **Language model.** Counts of all letter trigrams of the corpus, gathered in every task over
  whole texts and summed; the table is bounded by the alphabet, the counts grow with the corpus.
* **Restoring.** Words with digits or signs inside, words with a letter thrice in a row, and runs of
  single characters are read as lattices: each character stands for itself, for the letters
  it may replace, or for nothing (a separator, a repetition). The Viterbi algorithm finds the likeliest readings
  under the language model and the channel's costs, whatever their length. A run of single characters
  counts as one word and as the words it is most likely made of. All other words stand as they are.
  Texts are read in NFC; signs of any script are edges of words, and a word with other signs inside (a dash,
  ``#``, an ellipsis) is read as a whole without them and part by part.
* **Scores.** Stretches of characters that set toxic documents apart are selected on labelled
  documents outside the held-out fifth (at most ``TRAIN_ROWS``); a word weighs as much as its
  strongest stretch. A logistic regression over a document's sums gives the score. Labels, language,
  source and id never enter a score.

A null or empty text scores like any text without telling words. Rows that repeat an id are scored
one by one, so equal texts get equal scores. Without labels of both kinds every score is the share
of toxic labels (0.5 if there are none).
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonflow.llm.common import as_row, from_row, held_out, learnable, stored, texts_of

TRAIN_ROWS = 20_000
# Stretches kept, documents that one must be in, and how far it must stand out.
STRETCHES, LEAST_DOCS, LEAST_ODDS, LEAST_G2 = 4000, 5, 1.2, 12.0
SIZES = (4, 5, 6)
READINGS = 4
REMEMBERED = 300_000
# Distinct stretches, and distinct words, of labelled documents that a task holds before it sends on what it counted.
HELD_STRETCHES, HELD_WORDS = 400_000, 100_000
# Letters of a reading that are held as one piece, so that a word's cost grows with its length alone.
PIECE = 64

# Classes: 0 anything else, 1-26 a-z, then the small letters of Latin-1.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))
K = 64
CLASS = {c: i + 1 for i, c in enumerate(LETTERS)}
_TABLE = np.zeros(0x110000, dtype=np.int32)
for _c, _i in CLASS.items():
    _TABLE[ord(_c)] = _i

# Letters that a sign or digit may replace.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = set(" .-_*~'`,:;/\\^")
COST_SIGN, COST_SEPARATOR, COST_DROP, COST_REPEAT = 1.0, 0.3, 9.0, 0.3
EDGE = " "


# --- language model -----------------------------------------------------------------


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(K**3, dtype=np.int64)
    for batch in batches:
        # Two blanks between texts keep trigrams from crossing them.
        joined = "  ".join(composed(t) for t in batch.column(0).to_pylist() if t)
        for at in range(0, len(joined), 1 << 20):
            part = f" {joined[max(0, at - 2) : at + (1 << 20)].lower()} " if not at else joined[at - 2 : at + (1 << 20)].lower()
            c = _TABLE[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
            total += np.bincount((c[:-2] * K + c[1:-1]) * K + c[2:], minlength=K**3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["trigram", "n"])


def trigram_counts(docs: DataFrame) -> DataFrame:
    """``trigram, n`` over all letters and word edges of all texts."""
    counted = texts_of(docs).select("text").mapInArrow(_trigrams, "trigram int, n long")
    return counted.groupBy("trigram").agg(F.sum("n").alias("n"))


class LanguageModel:
    """Log probabilities of a letter or word edge after two others, with shorter contexts mixed in."""

    def __init__(self, counts: list[tuple[int, int]]) -> None:
        n = np.zeros(K**3)
        for at, c in counts:
            n[at] = c
        n = n.reshape(K, K, K)
        n[0, 0, 0] = 0
        one = (n.sum(axis=(0, 1)) + 0.5) / (n.sum() + 0.5 * K)
        two = n.sum(axis=0)
        two = (two + 20 * one) / (two.sum(axis=1, keepdims=True) + 20)
        three = (n + 5 * two[None]) / (n.sum(axis=2, keepdims=True) + 5)
        self.log = np.log(three).astype(np.float32)


# --- channel ------------------------------------------------------------------------


def _is_letter(c: str) -> bool:
    """Letters of any script, and the marks that scripts write them with."""
    return c.isalpha() or (c > "\x7f" and unicodedata.category(c)[0] == "M")


def _is_sign(c: str) -> bool:
    return c > "\x7f" and unicodedata.category(c)[0] in "PSZC"


# What is not seen, and accents left alone after letters and accents were put together.
_UNSEEN = re.compile("[\u00ad\u0300-\u036f\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufe00-\ufe0f\ufeff]")


def composed(text: str) -> str:
    """The text in NFC, without unseen characters and accents that no letter takes."""
    return text if text.isascii() else _UNSEEN.sub("", unicodedata.normalize("NFC", text))


def _options(word: str, i: int) -> list[tuple[str, float]]:
    """Letters that the character may stand for, and their costs; empty for nothing."""
    c = word[i]
    if c in CLASS or _is_letter(c):
        out = [(c, 0.0)]
        if i and word[i - 1] == c:
            out.append(("", COST_REPEAT))
        return out
    out = [(x, COST_SIGN) for x in STANDS_FOR.get(c, "")]
    out.append(("", COST_SEPARATOR if c in SEPARATORS else COST_DROP))
    return out


def readings(word: str, model: np.ndarray, n: int = READINGS, split: bool = False) -> list[str]:
    """The likeliest restored words, best first: Viterbi over the lattice, ``n`` paths a state.

    With ``split``, a word edge may stand before any letter, and what is given back is the word as it
    stands with blanks at the edges.
    """
    # A path is its score, the number of its pieces so far, and the letters after them.
    pieces: dict[tuple[int, str], int] = {}
    states: dict[tuple[int, int], list[tuple[float, int, str]]] = {(0, 0): [(0.0, 0, "")]}
    for i in range(len(word)):
        after: dict[tuple[int, int], list[tuple[float, int, str]]] = {}
        for letter, cost in _options(word, i):
            c = CLASS.get(letter, 0)
            said = word[i] if split else letter
            for (a, b), paths in states.items():
                to, gain = ((b, c), float(model[a, b, c]) - cost) if letter else ((a, b), -cost)
                after.setdefault(to, []).extend((s + gain, p, t + said) for s, p, t in paths)
                if split and letter and b:
                    gain = float(model[a, b, 0]) + float(model[b, 0, c]) - cost
                    after.setdefault((0, c), []).extend((s + gain, p, t + EDGE + said) for s, p, t in paths)
        states = {k: sorted(set(v), reverse=True)[:n] for k, v in after.items()}
        if i % PIECE == PIECE - 1:
            states = {k: [(s, pieces.setdefault((p, t), len(pieces) + 1), "") for s, p, t in v] for k, v in states.items()}
    before = {at: (p, t) for (p, t), at in pieces.items()}

    def whole(p: int, t: str) -> str:
        parts = [t]
        while p:
            p, t = before[p]
            parts.append(t)
        return "".join(reversed(parts))

    ended = [(s + float(model[a, b, 0]), p, t) for (a, b), paths in states.items() for s, p, t in paths if p or t]
    best = [text for text in (whole(p, t) for _, p, t in sorted(ended, reverse=True)) if text]
    return list(dict.fromkeys(best))[:n]


_EDGES = " .,;:!?\"'`()[]{}<>*$%&#|=~^-_/\\"
_THRICE = re.compile(r"([^\W\d_])\1\1")
# Single characters held apart: blanks between them, three at least.
_APART = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")


def _spelled(word: str) -> bool:
    """Letters only, none of them thrice in a row."""
    return (word.isalpha() or (not word.isascii() and all(map(_is_letter, word)))) and not _THRICE.search(word)


def disguised(word: str) -> bool:
    """Whether a lower-cased word without its edges is to be restored."""
    return not _spelled(word) and any(map(str.isalpha, word))


def _parts(word: str) -> list[str]:
    """What stands between signs that are neither letters in disguise nor separators."""
    kept = (c if _is_letter(c) or c in STANDS_FOR or c in SEPARATORS else " " for c in word)
    return [p for p in (p.strip(_EDGES) for p in "".join(kept).split(" ")) if p]


def forms(word: str, model: np.ndarray) -> list[list[str]]:
    """What a word of a text may say, likeliest first; one list for the whole, and one for each of
    the parts that foreign signs cut it into."""
    low = composed(word.lower())
    if not low.isascii():
        a, b = 0, len(low)
        while a < b and _is_sign(low[a]) and low[a] not in STANDS_FOR:
            a += 1
        while a < b and _is_sign(low[b - 1]) and low[b - 1] not in STANDS_FOR:
            b -= 1
        low = low[a:b]
    core = low.strip(_EDGES)
    while core and (_is_sign(core[0]) or _is_sign(core[-1])):
        core = core[1:] if _is_sign(core[0]) else core[:-1]
        core = core.strip(_EDGES)
    if core and _spelled(core) and low[0] not in STANDS_FOR:
        return [[core]]
    found = []
    # Signs at the edges may be letters too: both readings are tried.
    for w in dict.fromkeys((core, low.strip(" .,;:?\"'"))):
        if w and _spelled(w):
            found.append(w)
        elif w and disguised(w):
            found += readings(w, model)
    parts = _parts(core)
    cut = [[p] if _spelled(p) else readings(p, model) for p in parts if any(map(str.isalpha, p))] if len(parts) > 1 else []
    return [x for x in ([*dict.fromkeys(found)], *cut) if x]


def restored(word: str, model: np.ndarray) -> list[str]:
    """What a word of a text may say; the first is the likeliest."""
    return list(dict.fromkeys(w for found in forms(word, model) for w in found))


def held_apart(text: str) -> list[str]:
    """The runs of single characters, each without its blanks."""
    return [m.group().replace(" ", "").replace("\t", "") for m in _APART.finditer(text)]


def phrase(run: str, model: np.ndarray) -> list[str]:
    """A run of single characters as one word, and as the words it most likely is, if several."""
    low = run.lower()
    found = readings(low, model, split=True)[:1] if any(c.isalpha() for c in low) else []
    words = found[0].split(EDGE) if found else []
    return [run, *words] if len(words) > 1 else [run]


# --- features -----------------------------------------------------------------------


def stretches(word: str) -> set[str]:
    """The word with its edges, and the stretches of it that tell words apart."""
    w = f"^{word}$"
    out = {w[i : i + n] for n in SIZES for i in range(len(w) - n + 1)}
    out.add(w)
    return out


class Scorer:
    """Sums over a text's words of what each weighs, at most once looked up per distinct word."""

    def __init__(self, weights: dict[str, float], model: np.ndarray) -> None:
        self.model = model
        self.known: dict[str, float] = {}
        self.before: dict[str, float] = {}
        self.phrases: dict[str, list[str]] = {}
        self.marks = ahocorasick.Automaton()
        for stretch, weight in weights.items():
            self.marks.add_word(stretch, weight)
        self.marks.make_automaton()

    def _strongest(self, word: str) -> float:
        """Of a word of letters alone. Stretches hold edges, so whole words are found as such."""
        best = 0.0
        for _, weight in self.marks.iter(f"^{word}$") if self.marks else ():
            if weight > best:
                best = weight
        return best

    def _weigh(self, word: str) -> float:
        low = word.lower()
        core = low.strip(_EDGES)
        plain = core.isalpha() and low[0] not in STANDS_FOR and not _THRICE.search(core)
        if plain and (low.isascii() or unicodedata.is_normalized("NFC", low)):
            return self._strongest(core)
        return max(map(self._strongest, restored(word, self.model)), default=0.0)

    def _weight(self, word: str) -> float:
        """Words of late are remembered, and those before them as long as they come again."""
        weight = self.known.get(word)
        if weight is None:
            weight = self.before.get(word)
            if weight is None:
                weight = self._weigh(word)
            if len(self.known) >= REMEMBERED // 2:
                self.before, self.known = self.known, {}
            self.known[word] = weight
        return weight

    def sums(self, text: str) -> tuple[float, float, float, float]:
        text = composed(text)
        words = text.split()
        for run in held_apart(text):
            if run not in self.phrases:
                if len(self.phrases) > REMEMBERED // 10:
                    self.phrases.clear()
                self.phrases[run] = phrase(run, self.model)
            words += self.phrases[run]
        found = list(map(self.known.get, words))
        if None in found:
            found = [self._weight(w) if x is None else x for w, x in zip(words, found)]
        total, most, n = sum(found), max(found, default=0.0), len(words)
        return math.log1p(total), most, math.log1p(n), total / (n + 20.0)


class StretchCounts:
    """In how many toxic and clean documents each stretch is. Words and stretches are numbered as they come, so that a
    document is an array of numbers."""

    def __init__(self, model: np.ndarray) -> None:
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.words: dict[str, np.ndarray] = {}
        self.last = np.zeros(0, dtype=np.int64)
        self.counts = np.zeros((2, 0), dtype=np.int64)

    def full(self) -> bool:
        return len(self.number) > HELD_STRETCHES or len(self.words) > HELD_WORDS

    def _numbers(self, word: str) -> np.ndarray:
        number = self.number
        offered = {s for found in forms(word, self.model) for s in stretches(found[0])}
        return np.fromiter((number.setdefault(s, len(number)) for s in offered), dtype=np.int64, count=len(offered))

    def add(self, text: str, toxic: bool) -> None:
        text = composed(text)
        words = set(text.split())
        words.update(w for run in held_apart(text) for w in phrase(run, self.model))
        for w in words:
            if w not in self.words:
                self.words[w] = self._numbers(w)
        if not words:
            return
        if len(self.number) > len(self.last):
            more = 2 * len(self.number) - len(self.last)
            self.last = np.pad(self.last, (0, more))
            self.counts = np.pad(self.counts, ((0, 0), (0, more)))
        found = np.concatenate([self.words[w] for w in words])
        # Of equal numbers the one that was put down last stands for all.
        place = np.arange(len(found))
        self.last[found] = place
        self.counts[int(toxic), found[self.last[found] == place]] += 1

    def rows(self) -> pa.RecordBatch:
        names, n = pa.array(list(self.number), pa.string()), len(self.number)
        return pa.RecordBatch.from_arrays([names, *(pa.array(self.counts[k, :n]) for k in (1, 0))], ["stretch", "toxic", "clean"])


def _labelled_stretches(batches: Iterator[pa.RecordBatch], model: np.ndarray) -> Iterator[pa.RecordBatch]:
    counts = StretchCounts(model)
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.add(text or "", bool(label))
            if counts.full():
                yield counts.rows()
                counts.clear()
    yield counts.rows()


def select_stretches(train: DataFrame, model: np.ndarray) -> dict[str, float]:
    """The stretches that mark toxic documents, with their log odds; at most ``STRETCHES``."""
    size = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return {}
    counted = train.select("text", "label").mapInArrow(lambda b: _labelled_stretches(b, model), "stretch string, toxic long, clean long")
    counted = counted.groupBy("stretch").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")).where(f"a >= {LEAST_DOCS}")
    pa_, pb = (F.col("a") + 0.5) / (n1 + 1.0), (F.col("b") + 0.5) / (n0 + 1.0)
    both = (F.col("a") + F.col("b") + 1.0) / (n1 + n0 + 2.0)
    g2 = 2 * (F.col("a") * F.log(pa_ / both) + F.col("b") * F.log(pb / both))
    picked = counted.select("stretch", F.log(pa_ / pb).alias("odds"), g2.alias("g2")).where(f"odds >= {LEAST_ODDS} AND g2 >= {LEAST_G2}")
    return {r["stretch"]: r["odds"] for r in picked.orderBy(F.desc("g2"), "stretch").limit(STRETCHES).collect()}


# --- document scores ----------------------------------------------------------------


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton's method on standardised columns: ``mean, scale, weights`` (the last is the bias)."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    penalty = ridge * len(x) * np.diag([*[1.0] * x.shape[1], 1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty + 1e-9 * np.eye(len(w)), z.T @ (p - y) + penalty @ w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def _with_interaction(sums: np.ndarray) -> np.ndarray:
    return np.c_[sums, sums[:, 0] * sums[:, 2]]


def _sum_rows(batches: Iterator[pa.RecordBatch], weights: dict[str, float], model: np.ndarray) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(weights, model)
    for batch in batches:
        rows = [scorer.sums(t or "") for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], ["sums", "label"])


def _score_rows(
    batches: Iterator[pa.RecordBatch], weights: dict, model: np.ndarray, fitted: tuple | float, row_text: str | None = None
) -> Iterator[pa.RecordBatch]:
    """Scores next to the first column; the text is the second, or a field of the first."""
    scorer = Scorer(weights, model)
    name = "row" if row_text else "doc_id"
    for batch in batches:
        texts = batch.column(0).field(row_text) if row_text else batch.column(1)
        sums = [scorer.sums(t or "") for t in texts.to_pylist()]
        if isinstance(fitted, float):
            scores = np.full(len(sums), fitted)
        else:
            mean, scale, w = fitted
            x = _with_interaction(np.array(sums).reshape(-1, 4))
            scores = 1 / (1 + np.exp(-np.clip(((x - mean) / scale) @ w[:-1] + w[-1], -30, 30)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], [name, "score"])


class Model:
    """What ``learn`` found: small, so it is sent to every task."""

    def __init__(self, weights: dict[str, float], language: np.ndarray, fitted) -> None:
        self.weights, self.language, self.fitted = weights, language, fitted

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``doc_id, score`` of every row."""
        weights, language, fitted = self.weights, self.language, self.fitted
        return texts_of(docs, id_col, text_col).mapInArrow(lambda b: _score_rows(b, weights, language, fitted), "doc_id long, score double")


    def keep(self, docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
        """``docs`` without the documents that score ``threshold`` or more."""
        weights, language, fitted = self.weights, self.language, self.fitted
        rows = docs.select(as_row(docs))
        kind = rows.schema["row"].dataType.simpleString()
        scored = rows.mapInArrow(lambda b: _score_rows(b, weights, language, fitted, text_col), f"row {kind}, score double")
        return from_row(scored.where(F.col("score") < threshold), docs)


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    language = LanguageModel([(r["trigram"], r["n"]) for r in trigram_counts(docs).collect()]).log
    # At most ``rows`` ids of a few bytes: small enough to be sent to every task.
    known = F.broadcast(learnable(labels, label, rows).withColumnRenamed("doc_id", "labelled_id"))
    train = texts_of(docs).join(known, F.col("doc_id") == F.col("labelled_id")).select("text", "label")
    train = stored(train)
    weights = select_stretches(train, language)
    got = train.mapInArrow(lambda b: _sum_rows(b, weights, language), "sums array<double>, label int").collect()
    y = np.array([r["label"] for r in got], dtype=float)
    if len(set(y.tolist())) < 2:
        return Model(weights, language, float(y.mean()) if len(y) else 0.5)
    # Collected rows come in no set order; sorting makes the fit the same every time.
    x = np.array([r["sums"] for r in got])
    order = np.lexsort((*x.T, y))
    return Model(weights, language, fit_logistic(_with_interaction(x[order]), y[order]))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    scored = learn(docs, labels).score(docs)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
