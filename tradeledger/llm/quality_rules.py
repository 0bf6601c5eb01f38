"""Quality rules: text statistics and a decision list learned from labelled ones.

Sequential covering: a rule, a conjunction of thresholds, is grown condition by condition on
two thirds of the rows still uncovered, pruned on the other third, and kept while it does
better there than not having it. What it covers leaves the training set. The ordered rules
become one Spark conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.llm.common import map_texts

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_digits", "n_marks",
)


def covered_words(ids: np.ndarray, window: int = 3) -> int:
    """Words inside windows of ``window`` ids that occur twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    codes = ids[:n].copy()
    size = int(ids.max()) + 1
    for k in range(1, window):
        if size ** (k + 1) < 1 << 62:
            codes = codes * size + ids[k : k + n]
        else:  # number the prefixes first, so that the codes stay in 64 bits
            codes = np.unique(codes, return_inverse=True)[1] * size + ids[k : k + n]
    order = np.argsort(codes, kind="stable")
    same = codes[order[1:]] == codes[order[:-1]]
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    hit = np.zeros(len(ids), bool)
    for k in range(window):
        hit[k : k + n] |= again
    return int(hit.sum())


def statistics(text: bytes) -> tuple[int, ...]:
    """The values of STATISTICS for one text."""
    words = text.split()
    joined = b"".join(words)
    chars = len(joined) if text.isascii() else len(joined.decode())
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    seen: set[bytes] = set()
    lines = repeats = 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            repeats += line in seen
            seen.add(line)
    return (
        len(words), chars, len(text) - len(text.translate(None, SYMBOLS)), repeats, covered_words(ids), lines, len(number),
        len(text) - len(text.translate(None, UPPER)), len(text) - len(text.translate(None, DIGITS)), text.count(b"!"),
    )


def with_statistics(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and STATISTICS (long). A null text has the statistics of an empty one."""

    def make():
        return lambda texts: [list(c) for c in zip(*(statistics(t or b"") for t in texts))]

    return map_texts(docs, text, [T.StructField(n, T.LongType()) for n in STATISTICS], make, keep)


#: Ratios that rules may test, as (name, numerator, denominator); statistics may be tested as they are.
RATIOS = (
    ("chars_per_word", "word_chars", "n_words"),
    ("symbols_per_word", "n_symbols", "n_words"),
    ("repeat_share", "n_repeat_words", "n_words"),
    ("distinct_share", "n_distinct", "n_words"),
    ("upper_share", "n_upper", "word_chars"),
    ("digit_share", "n_digits", "word_chars"),
    ("marks_per_word", "n_marks", "n_words"),
    ("dup_line_share", "n_dup_lines", "n_lines"),
)
FEATURES = (*(name for name, _, _ in RATIOS), "n_words")


def feature_column(name: str) -> Column:
    for ratio, top, bottom in RATIOS:
        if ratio == name:
            return F.col(top) / F.greatest(F.col(bottom), F.lit(1))
    return F.col(name).cast("double")


def feature_matrix(rows: list) -> np.ndarray:
    columns = {n: np.array([r[n] for r in rows], float) for n in STATISTICS}
    made = [columns[top] / np.maximum(columns[bottom], 1) for _, top, bottom in RATIOS]
    return np.column_stack([*made, columns["n_words"]]) if rows else np.zeros((0, len(FEATURES)))


@dataclass
class Rule:
    """Conditions (feature, ">=" or "<=", threshold) that must all hold, and what it covered in training."""

    conditions: list[tuple[str, str, float]] = field(default_factory=list)
    bad: int = 0
    good: int = 0

    def covers(self, x: np.ndarray) -> np.ndarray:
        mask = np.ones(len(x), bool)
        for name, sign, value in self.conditions:
            v = x[:, FEATURES.index(name)]
            mask &= v >= value if sign == ">=" else v <= value
        return mask

    def column(self) -> Column:
        made = F.lit(True)
        for name, sign, value in self.conditions:
            v = feature_column(name)
            made = made & (v >= F.lit(value) if sign == ">=" else v <= F.lit(value))
        return made

    def __str__(self) -> str:
        return " and ".join(f"{n} {s} {v:.6g}" for n, s, v in self.conditions)


def _grow(x: np.ndarray, bad: np.ndarray, steps: int) -> Rule:
    """Adds the condition of the largest information gain until no good row is covered."""
    rule = Rule()
    inside = np.ones(len(x), bool)
    while bad[inside].sum() < inside.sum() and len(rule.conditions) < 4:
        p0, n0 = bad[inside].sum(), inside.sum()
        if p0 == 0:
            break
        best = (1e-9, None)
        for f, name in enumerate(FEATURES):
            v = x[inside, f]
            cuts = np.unique(np.quantile(v, np.linspace(0, 1, steps)))
            order = np.argsort(v, kind="stable")
            sorted_v, running = v[order], np.concatenate([[0], np.cumsum(bad[inside][order])])
            for sign in (">=", "<="):
                if sign == ">=":
                    at = np.searchsorted(sorted_v, cuts, "left")
                    p, n = running[-1] - running[at], len(v) - at
                else:
                    at = np.searchsorted(sorted_v, cuts, "right")
                    p, n = running[at], at
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / n) - math.log2(p0 / n0)), 0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (name, sign, float(cuts[k])))
        if best[1] is None:
            break
        rule.conditions.append(best[1])
        inside = rule.covers(x)
    return rule


def _worth(rule: Rule, x: np.ndarray, bad: np.ndarray) -> float:
    mask = rule.covers(x)
    p, n = bad[mask].sum(), mask.sum()
    return (2 * p - n) / n if n else -1.0


def learn(x: np.ndarray, bad: np.ndarray, seed: int = 7, max_rules: int = 16, min_covered: int = 3) -> list[Rule]:
    """Ordered rules for bad rows; rows that none covers are good. No labelled rows: no rules."""
    rules: list[Rule] = []
    part = np.random.default_rng(seed).permutation(len(x)) % 3  # fixed folds of the rows in their order
    left = np.ones(len(x), bool)
    while len(rules) < max_rules and bad[left].any():
        grow, prune = left & (part != 0), left & (part == 0)
        rule = _grow(x[grow], bad[grow], 64)
        best = (_worth(rule, x[prune], bad[prune]), len(rule.conditions))
        for size in range(1, len(rule.conditions)):  # cut conditions off the end
            worth = _worth(Rule(rule.conditions[:size]), x[prune], bad[prune])
            best = max(best, (worth, size), key=lambda b: (b[0], -b[1]))
        rule = Rule(rule.conditions[: best[1]])
        mask = rule.covers(x) & left
        rule.bad, rule.good = int(bad[mask].sum()), int((~bad[mask]).sum())
        if not rule.conditions or best[0] <= 0.5 or rule.bad < min_covered:
            break
        rules.append(rule)
        left &= ~mask
    return rules


def verdict_columns(rules: list[Rule]) -> tuple[Column, Column]:
    """The decision list as (kept, rule number or null): one ordered conditional expression each."""
    kept, number = None, None
    for i, rule in enumerate(rules):
        hit = rule.column()
        kept = F.when(hit, False) if kept is None else kept.when(hit, False)
        number = F.when(hit, i) if number is None else number.when(hit, i)
    if kept is None:
        return F.lit(True), F.lit(None).cast("int")
    return kept.otherwise(True), number.cast("int")
