"""URL filters: host rules, and a character language model for the urls that no rule judges.

Two smoothed variable-order Markov models, one of accepted and one of rejected urls, are
counted over all urls that a rule judges. The verdict of another url is its log-likelihood
ratio per character against a threshold calibrated on a fold the models have not seen.

Characters are taken from a fixed alphabet (letters without case, one symbol for all digits,
the usual punctuation, one symbol for the rest), so a model has at most
``len(SYMBOLS) ** (order + 1)`` cells however many urls there are: that bounds what is
collected and broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.llm.common import col, free_name, map_texts

#: Symbol 0 pads the start, 1 is any digit, 2 any other character.
SYMBOLS = "^0*abcdefghijklmnopqrstuvwxyz/.-_?=&%#:+~"
ORDER = 3


@dataclass(frozen=True)
class HostRule:
    verdict: str  # allow or block
    host: str
    path: str  # starts with /

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed values of the registered query.
RULES = (
    HostRule("block", "net", "/"),
    HostRule("allow", "example.net", "/en/"),
    HostRule("block", "example.com", "/de/"),
    HostRule("allow", "org", "/fr/"),
)
#: Result columns; a kept column of such a name is left out.
MADE = ("host", "path", "rule", "verdict", "url_score", "threshold")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path as text functions; both empty for null and for a url without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def matched_rule(host: Column, path: Column, rules: tuple[HostRule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest fitting rule, null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def symbol_table() -> np.ndarray:
    codes = np.full(256, 2, np.int64)
    for i, c in enumerate(SYMBOLS[3:], 3):
        codes[ord(c)] = i
        codes[ord(c.upper())] = i
    codes[ord("0") : ord("9") + 1] = 1
    return codes


CODES = symbol_table()


def gram_codes(url: bytes, order: int = ORDER) -> np.ndarray:
    """For each byte, the symbol and the ``order`` symbols before it as one number."""
    symbols = np.concatenate([np.zeros(order, np.int64), CODES[np.frombuffer(url, np.uint8)]])
    grams = np.zeros(len(url), np.int64)
    for k in range(order + 1):
        grams = grams * len(SYMBOLS) + symbols[k : k + len(url)]
    return grams


def gram_counts(urls: DataFrame, url: str, label: str, order: int = ORDER) -> DataFrame:
    """(label, gram, n) over all rows; each task adds up its own grams before the shuffle."""
    cells = len(SYMBOLS) ** (order + 1)
    schema = "label string, gram long, n long"

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            for t, lab in zip(texts, batch.column(1).to_pylist()):
                if lab is not None and t:
                    counts = sums.setdefault(lab, np.zeros(cells, np.int32))
                    np.add.at(counts, gram_codes(t, order), 1)
        for lab, counts in sums.items():
            found = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lab] * len(found), pa.string()), pa.array(found, pa.int64()), pa.array(counts[found], pa.int64())],
                names=["label", "gram", "n"],
            )

    pairs = urls.select(col(url).cast("string").alias("url"), col(label).alias("label"))
    return pairs.mapInArrow(run, schema).groupBy("label", "gram").agg(F.sum("n").alias("n"))


def log_probabilities(grams: np.ndarray, n: np.ndarray, order: int = ORDER) -> np.ndarray:
    """log p(symbol | context) for every cell, by Witten-Bell interpolation from order 0 up."""
    size = len(SYMBOLS)
    full = np.zeros(size ** (order + 1))
    full[grams] = n
    p = np.full(1, 1.0 / size)  # uniform below order 0
    for k in range(order + 1):
        counts = full.reshape(-1, size ** (k + 1)).sum(axis=0).reshape(-1, size)
        total, kinds = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
        # the model of the context without its first symbol
        lower = np.tile(p.reshape(-1, size), (size, 1)) if k else np.full((1, size), p[0])
        seen = total > 0
        mixed = (counts + kinds * lower) / np.where(seen, total + kinds, 1)
        p = np.where(seen, mixed, lower).ravel()
    return np.log(p)


@dataclass
class UrlModel:
    """Log-likelihood ratio of every gram (accepted minus rejected), and the threshold."""

    ratio: np.ndarray
    threshold: float = 0.0

    def score(self, url: bytes) -> float:
        """Mean ratio per byte, rounded to 12 digits; 0 for an empty url."""
        if not url:
            return 0.0
        return round(float(self.ratio[gram_codes(url)].sum(dtype=np.float64) / len(url)), 12)


def fit(urls: DataFrame, url: str, label: str) -> UrlModel:
    """Counts three quarters of the urls with label allow or block, calibrates on the rest.

    Folds go by a hash of the url, so repeated urls stay together. The threshold is the
    middle of the best gap of balanced accuracy over a histogram of all calibration scores
    in steps of 0.01. Without urls of both kinds it is 0.
    """
    folds = urls.filter(F.col(label).isNotNull()).withColumn("_fold", F.pmod(F.xxhash64(col(url)), F.lit(4)))
    # collected as columns: at most len(SYMBOLS) ** (ORDER + 1) cells of 17 bytes a model
    cells = gram_counts(folds.filter("_fold <> 3"), url, label).select((F.col("label") == "allow").alias("allow"), "gram", "n").toArrow()
    allow, gram, n = (cells[name].to_numpy() for name in ("allow", "gram", "n"))
    logs = {kind: log_probabilities(gram[allow == own], n[allow == own]) for kind, own in (("allow", True), ("block", False))}
    model = UrlModel((logs["allow"] - logs["block"]).astype(np.float32))
    scored = with_scores(folds.filter("_fold = 3"), url, model, [label])
    cells = scored.groupBy(col(label).alias("label"), F.floor(F.col("url_score") * 100).alias("bin")).count().collect()
    bins = sorted({r["bin"] for r in cells})
    counts = {k: np.array([sum(r["count"] for r in cells if r["bin"] == b and r["label"] == k) for b in bins]) for k in logs}
    if all(c.sum() for c in counts.values()):
        good, bad = counts["allow"] / counts["allow"].sum(), counts["block"] / counts["block"].sum()
        # accepted at a cut: everything from this bin on
        worth = np.cumsum(good[::-1])[::-1] + np.concatenate([[0], np.cumsum(bad)[:-1]])
        k = int(np.argmax(np.round(worth, 9)))
        low = bins[k - 1] + 1 if k else bins[k]
        model.threshold = (low + bins[k]) / 200
    return model


def with_scores(urls: DataFrame, url: str, model: UrlModel, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and url_score (double)."""
    shared = urls.sparkSession.sparkContext.broadcast(model)  # a fixed number of cells

    def make():
        own = shared.value
        return lambda texts: [[own.score(t or b"") for t in texts]]

    return map_texts(urls, url, [T.StructField("url_score", T.DoubleType())], make, keep)


def filter_urls(pages: DataFrame, url: str = "url", rules: tuple[HostRule, ...] = RULES, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns with host, path, rule, verdict, url_score and threshold.

    A url with a fitting rule gets the rule's verdict (the longest rule decides); any other
    is allowed if its score reaches the threshold. Null urls have empty host and path and
    score 0. Repeated rows are judged alike; an empty table gives an empty result.
    """
    keep = [c for c in (pages.columns if keep is None else keep) if c.lower() not in MADE]
    address = free_name(pages, "address")
    pages = pages.select(*[col(c) for c in keep], col(url).cast("string").alias(address))
    host, path = host_and_path(F.col(address))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    judged = pages.select(F.col(address).alias("url"), host.alias("host"), path.alias("path"))
    model = fit(judged.select("url", verdict.alias("kind")), "url", "kind")
    scored = with_scores(pages, address, model, [*keep, address]).withColumns({"host": host, "path": path})
    scored = scored.withColumns({"rule": rule, "verdict": verdict, "threshold": F.lit(model.threshold)})
    method = F.when(F.col("url_score") >= F.col("threshold"), "allow").otherwise("block")
    return scored.withColumn("verdict", F.coalesce("verdict", method)).select(*[col(c) for c in keep], *MADE)
