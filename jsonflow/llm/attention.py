"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words, all of them, over the whole text. Every passage is encoded
from counts of its bytes, byte pairs and words; a small network learns from document labels alone which passages to attend to
(gated attention) and scores the attention-weighted mean of their encodings.

Passages are encoded and scored inside the row's task, in numpy over whole batches; nothing is shuffled.
The network is fitted on the driver on all passages of a bounded sample of labelled documents outside the
held-out fifth: at most ``TRAIN_ROWS`` of them in the order of a hash of their ids, without those of more than
``LONGEST_BAG`` passages, as far as they have ``TRAIN_PASSAGES`` passages together. That bounds what is collected.
Labels, language, source and id never enter a score.

A null or empty text is one passage without words. Rows that repeat an id are scored one by one, and a text's
score does not depend on the rows beside it, so equal texts get equal scores. Without labels of both kinds every
score is the share of good labels (0.5 if there are none). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jsonflow.llm.common import held_out, learnable, stored, texts_of
from jsonflow.llm.hashing import BLANK, Rolling, as_bytes, mix, word_spans

PASSAGE = 64
TRAIN_ROWS, TRAIN_PASSAGES, LONGEST_BAG = 4000, 100_000, 5000
PAIRS = 128
HIDDEN, ATTENTION = 32, 16
EPOCHS, BATCH, RATE, DECAY = 30, 64, 0.003, 1e-4
# Bytes of text encoded at a time.
STRETCH = 1 << 21

# Kinds of bytes: small, capital, digit, blank, line end, each common sign, other signs, beyond ASCII.
_SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[]_{|}"
_KIND = np.full(256, 5, dtype=np.int64)
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 0, 1, 2
_KIND[BLANK] = 3
_KIND[10] = 4
_KIND[128:] = 6
for _i, _b in enumerate(_SIGNS):
    _KIND[_b] = 7 + _i
KINDS = 7 + len(_SIGNS)
WIDTH = KINDS + PAIRS + 4


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and how many each text has (one at least)."""
    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined, dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(sizes)
    starts, stops = word_spans(data)
    # Words per text, then the passage of each word and of each byte.
    before = np.searchsorted(starts, np.r_[0, ends])
    n_words = np.diff(before)
    counts = np.maximum(1, -(-n_words // PASSAGE))
    first = np.r_[0, np.cumsum(counts)[:-1]]
    text_of = np.repeat(np.arange(len(texts)), n_words)
    of_word = first[text_of] + (np.arange(len(starts)) - before[text_of]) // PASSAGE
    total = int(counts.sum())
    # A passage's bytes run from its first word to the next passage's first word.
    step = np.zeros(len(data) + 1, dtype=np.int64)
    opens = np.flatnonzero(np.r_[True, of_word[1:] != of_word[:-1]]) if len(of_word) else np.empty(0, dtype=np.int64)
    marks = np.full(total, -1, dtype=np.int64)
    marks[of_word[opens]] = starts[opens]
    begin = ends - sizes
    marks[first] = begin
    step[marks[marks >= 0]] += 1
    of_byte = np.cumsum(step[:-1]) - 1
    size = np.bincount(of_byte, minlength=total).astype(float)
    kinds = np.bincount(of_byte * KINDS + _KIND[data], minlength=total * KINDS).reshape(total, KINDS)
    pair = (data[:-1].astype(np.int64) * 31 + data[1:]) * 2654435761 >> 7 & (PAIRS - 1)
    # The byte after a text's end belongs to the next text.
    inside = np.ones(len(pair), dtype=bool)
    inside[ends[:-1] - 1] = False
    pairs = np.bincount((of_byte[:-1] * PAIRS + pair)[inside], minlength=total * PAIRS).reshape(total, PAIRS)

    words = np.bincount(of_word, minlength=total).astype(float)
    letters = np.bincount(of_word, weights=stops - starts, minlength=total)
    plain = Rolling(data).of(starts, stops)
    _, once = np.unique(mix(plain ^ mix(of_word.astype(np.uint64), 3)), return_index=True)
    distinct = np.bincount(of_word[once], minlength=total).astype(float)
    again = np.zeros(len(starts))
    if len(starts) > 1:
        again[1:] = (plain[1:] == plain[:-1]) & (of_word[1:] == of_word[:-1])
    twice = np.bincount(of_word, weights=again, minlength=total) if len(starts) else np.zeros(total)
    safe_size, safe_words = np.maximum(size, 1)[:, None], np.maximum(words, 1)
    extra = np.stack([letters / safe_words, distinct / safe_words, twice / safe_words, np.log1p(words)], axis=1)
    return np.concatenate([np.sqrt(kinds / safe_size), np.sqrt(pairs / safe_size), extra], axis=1).astype(np.float32), counts


class Network:
    """Passage encoder, gated attention and a logistic score of the attended mean."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 0) -> None:
        r = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        d, h, a = len(mean), HIDDEN, ATTENTION
        self.p = [
            r.normal(0, d**-0.5, (d, h)), np.zeros(h), r.normal(0, h**-0.5, (h, a)), r.normal(0, h**-0.5, (h, a)),
            r.normal(0, a**-0.5, a), r.normal(0, h**-0.5, h), np.zeros(1),
        ]

    def forward(self, x: np.ndarray, counts: np.ndarray) -> tuple:
        e, be, v, u, w, c, b = self.p
        x = (x - self.mean) / self.scale
        at = np.r_[0, np.cumsum(counts)[:-1]]
        h = np.tanh(x @ e + be)
        t, g = np.tanh(h @ v), 1 / (1 + np.exp(-(h @ u)))
        s = (t * g) @ w
        s = np.exp(s - np.repeat(np.maximum.reduceat(s, at), counts))
        att = s / np.repeat(np.add.reduceat(s, at), counts)
        z = np.add.reduceat(att[:, None] * h, at)
        logit = np.clip(z @ c + b, -30, 30)
        return x, at, h, t, g, att, z, 1 / (1 + np.exp(-logit))

    def gradients(self, x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        e, be, v, u, w, c, b = self.p
        x, at, h, t, g, att, z, p = self.forward(x, counts)
        dl = (p - y) / len(y)
        dz = np.repeat(dl[:, None] * c, counts, axis=0)
        da = (dz * h).sum(axis=1)
        ds = att * (da - np.repeat(np.add.reduceat(att * da, at), counts))
        dt, dg = ds[:, None] * w * g * (1 - t * t), ds[:, None] * w * t * g * (1 - g)
        dh = (att[:, None] * dz + dt @ v.T + dg @ u.T) * (1 - h * h)
        return [x.T @ dh, dh.sum(axis=0), h.T @ dt, h.T @ dg, (t * g).T @ ds, z.T @ dl, np.array([dl.sum()])]

    def score(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """One score a text. Texts go through the network one by one: the order in which a matrix
        product adds depends on its shape, and so would the last digits on the rows beside."""
        ends = np.cumsum(counts)
        return np.array([self.forward(x[b - n : b], np.array([n]))[-1][0] for b, n in zip(ends, counts)])


def fit(bags: list[np.ndarray], y: np.ndarray, seed: int = 0) -> Network:
    """Adam over shuffled batches of bags, from document labels alone."""
    whole = np.concatenate(bags)
    net = Network(whole.mean(axis=0), whole.std(axis=0) + 0.01, seed)
    counts = np.array([len(b) for b in bags])
    m, v = [np.zeros_like(p) for p in net.p], [np.zeros_like(p) for p in net.p]
    r, step = np.random.default_rng(seed), 0
    for _ in range(EPOCHS):
        order = r.permutation(len(bags))
        for lo in range(0, len(order), BATCH):
            pick = order[lo : lo + BATCH]
            step += 1
            for i, g in enumerate(net.gradients(np.concatenate([bags[k] for k in pick]), counts[pick], y[pick])):
                g = g + DECAY * net.p[i]
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                net.p[i] = net.p[i] - RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return net


def _stretches(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Texts in groups of bounded size; a longer text is a group of its own."""
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > STRETCH:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, sizes = [], []
        for group in _stretches(as_bytes(batch.column(1))):
            x, counts = passages(group)
            out += [bag.astype(np.float16).tobytes() for bag in np.split(x, np.cumsum(counts)[:-1])]
            sizes += counts.tolist()
        columns = [batch.column(0), batch.column(2), pa.array(out, pa.binary()), pa.array(sizes, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "bag", "n"])


def _sample(bags: DataFrame, most: int, longest: int) -> DataFrame:
    """The bags of whole documents, in the order of a hash of their ids, as far as they have ``most`` passages."""
    sizes = bags.groupBy("doc_id").agg(F.sum("n").alias("n")).where(F.col("n") <= longest)
    # As many rows as labelled documents were asked for, a few bytes each.
    upto = F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = sizes.select(F.col("doc_id").alias("chosen_id"), upto.alias("upto")).where(F.col("upto") <= most)
    return bags.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id"), "left_semi")


def _scores(batches: Iterator[pa.RecordBatch], net: Network | float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if isinstance(net, float):
            scores = np.full(batch.num_rows, net)
        else:
            scores = np.concatenate([net.score(*passages(g)) for g in _stretches(as_bytes(batch.column(1)))] or [np.empty(0)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores.astype(float))], ["doc_id", "score"])


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> Network | float:
    """The fitted network, or the share of good labels where there is nothing to tell apart."""
    # At most ``rows`` ids of a few bytes: small enough to be sent to every task.
    known = F.broadcast(learnable(labels, label, rows).withColumnRenamed("doc_id", "labelled_id"))
    train = texts_of(docs).join(known, F.col("doc_id") == F.col("labelled_id")).select("doc_id", "text", "label")
    bags = stored(train.mapInArrow(_bags, "doc_id long, label int, bag binary, n long"))
    got = sorted(_sample(bags, TRAIN_PASSAGES, LONGEST_BAG).collect(), key=lambda r: (r["doc_id"], bytes(r["bag"])))
    y = np.array([r["label"] for r in got], dtype=float)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    return fit([np.frombuffer(r["bag"], dtype=np.float16).reshape(-1, WIDTH).astype(np.float32) for r in got], y)


def score(docs: DataFrame, net: Network | float) -> DataFrame:
    """``doc_id, score`` of every row."""
    return texts_of(docs).mapInArrow(lambda b: _scores(b, net), "doc_id long, score double")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    scored = score(docs, learn(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
