"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line gets the label good or bad from its own features and those of the lines around it;
the chain couples neighbouring labels. Forward-backward gives each line's probability of
being good; weighted by line length they make up the quality of the document, which a
logistic curve fitted on the training documents turns into a probability.

Training labels belong to documents: every line of a training document carries its label.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tradeledger.llm.common import chunks, map_texts

#: Training sequences are cut into pieces of at most so many lines; scoring uses whole documents.
TRAIN_LINES = 64
KINDS = 7  # upper, digit, space, symbol, sentence mark, exclamation, other
OWN = 12


def byte_kinds() -> np.ndarray:
    kinds = np.full(256, 6, np.int64)
    kinds[ord("A") : ord("Z") + 1] = 0
    kinds[ord("0") : ord("9") + 1] = 1
    for i, chars in enumerate((b" \t\r\x0b\x0c", b"#*$%&|<>", b".,;:?'\"-", b"!"), 2):
        kinds[list(chars)] = i
    return kinds


BYTE_KINDS = byte_kinds()


def line_features(lines: list[bytes], first: np.ndarray) -> np.ndarray:
    """One row of OWN features per line; ``first`` marks the first line of each document."""
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    data = np.frombuffer(b"".join(lines), np.uint8)
    owner = np.repeat(np.arange(len(lines), dtype=np.int64) * KINDS, lengths)
    counts = np.bincount(owner + BYTE_KINDS[data], minlength=len(lines) * KINDS).reshape(-1, KINDS)
    shares = counts / np.maximum(lengths, 1)[:, None]
    n_words, distinct, again = np.zeros(len(lines)), np.ones(len(lines)), np.zeros(len(lines))
    seen: set[bytes] = set()
    for i, line in enumerate(lines):
        if first[i]:
            seen.clear()
        words = line.split()
        if words:
            n_words[i] = len(words)
            distinct[i] = len(set(words)) / len(words)
            again[i] = line in seen
            seen.add(line)
    return np.column_stack([
        np.log1p(lengths) / 5, shares[:, 0], shares[:, 1], shares[:, 2], shares[:, 3] * 5, shares[:, 4], shares[:, 5] * 5,
        distinct, np.log1p(n_words) / 5, lengths / np.maximum(n_words, 1) / 10, again, n_words < 3,
    ])


def with_neighbours(own: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after (zeros at the ends) and a constant."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[starts[:-1]] = 0
    after[starts[1:] - 1] = 0
    return np.column_stack([own, before, after, np.ones(len(own))])


def split_lines(texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray]:
    """Non-empty lines of all texts and the start of each text; a text without any has one empty line."""
    lines: list[bytes] = []
    starts = [0]
    for t in texts:
        own = [x for x in (t or b"").split(b"\n") if x.strip()]
        lines += own or [b""]
        starts.append(len(lines))
    return lines, np.array(starts)


def sequence_features(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, starts and lengths in bytes of all lines."""
    lines, starts = split_lines(texts)
    first = np.zeros(len(lines), bool)
    first[starts[:-1]] = True
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    return with_neighbours(line_features(lines, first), starts), starts, lengths


@dataclass
class Crf:
    """Weights of the label good, of label pairs, feature scale, and the logistic calibration."""

    weights: np.ndarray
    pairs: np.ndarray  # pairs[a, b]: score of label b after label a
    mean: np.ndarray
    scale: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights

    def document_scores(self, texts: list[bytes | None]) -> np.ndarray:
        x, starts, lengths = sequence_features(texts)
        good, _ = marginals(self.emissions(x), self.pairs, starts)
        weight = np.maximum(lengths, 1)
        raw = np.add.reduceat(good * weight, starts[:-1]) / np.add.reduceat(weight, starts[:-1])
        return 1 / (1 + np.exp(-(self.slope * logit(raw) + self.offset)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def log_add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def marginals(emit: np.ndarray, pairs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every line, and the expected number of each label pair over all sequences.

    All sequences advance together: step t handles the t-th line of those that are long
    enough. Long sequences come first, so each step works on a prefix.
    """
    sizes = np.diff(starts)
    order = np.argsort(-sizes, kind="stable")
    sizes, begin = sizes[order], starts[:-1][order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(1, longest + 1), "right")  # sequences with > t lines
    forward = np.zeros((len(emit), 2))
    forward[begin, 1] = emit[begin]
    for t in range(1, longest):
        here = begin[: active[t]] + t
        last = forward[here - 1]
        forward[here, 0] = log_add(last[:, 0] + pairs[0, 0], last[:, 1] + pairs[1, 0])
        forward[here, 1] = log_add(last[:, 0] + pairs[0, 1], last[:, 1] + pairs[1, 1]) + emit[here]
    backward = np.zeros((len(emit), 2))
    for t in range(longest - 2, -1, -1):
        here = begin[: active[t + 1]] + t
        after = backward[here + 1].copy()
        after[:, 1] += emit[here + 1]
        backward[here, 0] = log_add(pairs[0, 0] + after[:, 0], pairs[0, 1] + after[:, 1])
        backward[here, 1] = log_add(pairs[1, 0] + after[:, 0], pairs[1, 1] + after[:, 1])
    joint = forward + backward
    total = log_add(joint[:, 0], joint[:, 1])
    good = np.exp(joint[:, 1] - total)
    inner = np.ones(len(emit), bool)
    inner[starts[:-1]] = False
    at = np.flatnonzero(inner)  # lines with one before them
    expected = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            score = forward[at - 1, a] + pairs[a, b] + backward[at, b] + (emit[at] if b else 0)
            expected[a, b] = np.exp(score - total[at]).sum()
    return good, expected


def train(texts: list[bytes], labels: list[int], steps: int = 120, ridge: float = 2.0) -> Crf:
    """Maximum conditional likelihood by full-batch Adam; the same rows give the same model.

    Without labelled texts of both kinds the model scores every document 1 (only good seen, or
    nothing) or 0 (only bad seen).
    """
    n_features = 3 * OWN + 1
    if len(set(labels)) < 2:
        constant = -9.0 if set(labels) == {0} else 9.0
        return Crf(np.zeros(n_features), np.zeros((2, 2)), np.zeros(n_features), np.ones(n_features), 0.0, constant)
    parts = [sequence_features(texts[a:b])[:2] for a, b in chunks(texts)]
    x = np.concatenate([p[0] for p in parts])
    sizes = np.concatenate([np.diff(p[1]) for p in parts])
    y = np.repeat(np.array(labels, float), sizes)
    pieces: list[int] = []
    for size in sizes:
        pieces += [TRAIN_LINES] * (size // TRAIN_LINES) + ([size % TRAIN_LINES] if size % TRAIN_LINES else [])
    starts = np.concatenate([[0], np.cumsum(pieces)])
    whole = np.concatenate([[0], np.cumsum(sizes)])
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[-1], scale[scale < 1e-6] = 0, 1
    z = np.clip((x - mean) / scale, -6, 6)
    inner = np.ones(len(y), bool)
    inner[starts[:-1]] = False
    at = np.flatnonzero(inner)
    observed = np.zeros((2, 2))
    np.add.at(observed, (y[at - 1].astype(int), y[at].astype(int)), 1)
    theta = np.zeros(n_features + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        good, expected = marginals(z @ theta[:-4], theta[-4:].reshape(2, 2), starts)
        slope = np.concatenate([z.T @ (y - good), (observed - expected).ravel()]) - ridge * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    model = Crf(theta[:-4], theta[-4:].reshape(2, 2), mean, scale)
    good, _ = marginals(model.emissions(x), model.pairs, whole)
    lengths = np.concatenate([sequence_lengths(texts[a:b]) for a, b in chunks(texts)])
    raw = np.add.reduceat(good * lengths, whole[:-1]) / np.add.reduceat(lengths, whole[:-1])
    model.slope, model.offset = logistic(logit(raw), np.array(labels, float))
    return model


def sequence_lengths(texts: list[bytes]) -> np.ndarray:
    return np.maximum(np.fromiter(map(len, split_lines(texts)[0]), np.int64), 1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Slope (at least 0) and offset of a ridge logistic curve, by Newton steps."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(2) * 0.1
        w = w + np.linalg.solve(h, a.T @ (y - p) - ridge * 0.1 * w)
    return max(float(w[0]), 0.0), float(w[1])


def classify(docs: DataFrame, model: Crf, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns with score (double, 12 digits), n_lines and n_bad_lines (long).

    Null and empty texts count as one empty line. Repeated rows score alike; any number of
    lines is handled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def make():
        own = shared.value

        def step(texts):
            x, starts, lengths = sequence_features(texts)
            good, _ = marginals(own.emissions(x), own.pairs, starts)
            weight = np.maximum(lengths, 1)
            raw = np.add.reduceat(good * weight, starts[:-1]) / np.add.reduceat(weight, starts[:-1])
            score = 1 / (1 + np.exp(-(own.slope * logit(raw) + own.offset)))
            bad = np.add.reduceat((good < 0.5).astype(np.int64), starts[:-1])
            return [np.round(score, 12), np.diff(starts), bad]

        return step

    fields = [T.StructField("score", T.DoubleType()), T.StructField("n_lines", T.LongType()), T.StructField("n_bad_lines", T.LongType())]
    return map_texts(docs, text, fields, make, keep)
