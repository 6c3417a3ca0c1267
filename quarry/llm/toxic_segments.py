"""Toxicity by maximum-scoring segments.

Training (labelled rows of the training folds only):

1. Log-odds.  Per token, the documents of each class that contain it give a
   log-odds ratio under an informative Dirichlet prior (a uniform part plus a
   part in proportion to the token's share of all labelled documents).  Where
   it lies ``Z`` standard deviations from zero it is the token's weight, else
   the token weighs nothing.  Every token also pays a fixed drift, which makes
   the expected weight of ordinary text negative.
2. Calibration.  The weights of tokens in clean training documents give the
   decay ``lam`` of the extreme-value law of the best segment of ordinary text
   (the root of E[exp(lam * weight)] = 1) and, from the tokens that can start
   a segment, its constant K = E[exp(lam * weight); weight > 0];
   P(best >= s) = 1 - exp(-K n exp(-lam s)) for n tokens.
3. A one-feature logistic regression turns a document's evidence (the summed
   -log10 p of its segments) into the probability of label 1.

Scoring.  All maximal scoring segments are found in one pass per text (prefix
sums and a stack); those with p at most ``ALPHA`` are toxic passages.

Scale.  Tokens are hashed to ``BUCKETS`` buckets, so the model that every task
holds is one fixed-size array however large the vocabulary; only buckets with
a weight are shipped.  Fitting uses at most ``MAX_LABELLED`` labelled rows, the
same on every run; the sample is small enough to broadcast by that bound.
Scoring reads every text once, whole, and shuffles nothing.

Edge cases.  Null and blank texts have no tokens, no evidence and the score of
evidence zero.  Repeated labels of a document each count.  Without labels of
both classes every score is the label mean (0 if there are no labels).
Repeated rows are scored alike.  An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import labelled_sample, logistic_1d, map_texts, saved, text_bytes

#: Labelled rows used for fitting, at most.
MAX_LABELLED = 40_000
BUCKETS = 1 << 20
#: Uniform and proportional parts of the prior, in documents.
PRIOR_FLAT, PRIOR_SHARE = 0.5, 50.0
#: Standard deviations from zero of a log-odds ratio that counts.
Z = 3.0
DRIFT = 1.0
#: Largest p-value of a significant segment.
ALPHA = 0.05
#: Word bytes: digits, letters (lower-cased) and everything beyond ASCII.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c > 127 else 32
                   for c in range(256))
#: Steps of the scaled evidence in which the calibration counts rows.
DIGITS = 2
#: Steps of a weight in the histogram of ordinary text.
STEP = 0.05


@dataclass
class Model:
    """Weights by bucket (drift included), extreme-value and logistic parameters."""

    buckets: np.ndarray
    weights: np.ndarray
    lam: float
    const: float
    intercept: float
    slope: float

    def table(self) -> np.ndarray:
        t = np.full(BUCKETS, -DRIFT, dtype=np.float32)
        t[self.buckets] += self.weights.astype(np.float32)
        return t


def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words)) & np.uint32(BUCKETS - 1)


def segments(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end past the last, score), in
    linear time: each segment is merged to the left while that raises it."""
    hot = np.flatnonzero(weights > 0)
    if not len(hot):
        return []
    prefix = np.concatenate(([0.0], np.cumsum(weights, dtype=np.float64)))
    # Stack entries: start, end, prefix before start, prefix at end, and the
    # nearest entry below with a smaller prefix before its start.
    stack: list[tuple[int, int, float, float, int]] = []
    for at in hot.tolist():
        start, end, low, high = at, at + 1, float(prefix[at]), float(prefix[at + 1])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                stack.append((start, end, low, high, j))
                break
            start, low = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, high - low) for a, b, low, high, _ in stack]


def p_value(score: float, n: int, lam: float, const: float) -> float:
    """Chance of a segment this good in n tokens of ordinary text."""
    return float(-np.expm1(-const * n * np.exp(-lam * score)))


def passages(text: bytes | None, table: np.ndarray, lam: float, const: float,
             alpha: float = ALPHA) -> tuple[list[tuple[int, int, float]], float]:
    """Significant segments (first word, last word, p) and the evidence."""
    words = tokens(text)
    if not words:
        return [], 0.0
    found, evidence = [], 0.0
    for a, b, s in segments(table[hashed(words)]):
        p = max(p_value(s, len(words), lam, const), 1e-300)
        evidence -= float(np.log10(p))
        if p <= alpha:
            found.append((a, b - 1, p))
    return found, evidence


def token_counts(sample: DataFrame, text_col: str) -> DataFrame:
    """(bucket, toxic, clean, n): documents of each class with the bucket, and
    its occurrences in clean ones, over the sample (``_y``, text)."""
    def run(batches):
        seen = {y: np.zeros(BUCKETS, dtype=np.int32) for y in (0, 1)}
        times = np.zeros(BUCKETS, dtype=np.int64)
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                h = hashed(tokens(t))
                seen[y][np.unique(h)] += 1
                if y == 0:
                    np.add.at(times, h, 1)
        at = np.flatnonzero(seen[0] + seen[1])
        for lo in range(0, len(at), 1 << 16):
            part = at[lo:lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(seen[1][part].astype(np.int64)),
                 pa.array(seen[0][part].astype(np.int64)), pa.array(times[part])],
                names=["bucket", "toxic", "clean", "n"])

    return (sample.select("_y", text_bytes(text_col).alias("_text"))
            .mapInArrow(run, "bucket int, toxic long, clean long, n long")
            .groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("toxic", "clean", "n")]))


def log_odds(counts: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """Counts plus ``weight``: the log-odds ratio, 0 unless it is ``Z``
    standard deviations from zero."""
    prior = F.lit(PRIOR_FLAT) + F.lit(PRIOR_SHARE) * (F.col("toxic") + F.col("clean")) / (n_toxic + n_clean)
    total = 2 * PRIOR_FLAT + PRIOR_SHARE

    def logit(seen: str, n: int) -> Column:
        yes = F.col(seen) + F.col("_prior")
        return F.log(yes / (F.lit(float(n)) + total - yes))

    spread = F.sqrt(1 / (F.col("toxic") + F.col("_prior")) + 1 / (F.col("clean") + F.col("_prior")))
    ratio = F.col("_ratio")
    return (counts.withColumn("_prior", prior)
            .withColumn("_ratio", logit("toxic", n_toxic) - logit("clean", n_clean))
            .withColumn("weight", F.when(F.abs(ratio) > F.lit(Z) * spread, ratio).otherwise(0.0))
            .drop("_prior", "_ratio"))


def decay(weights: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(share * exp(lam * weight)) = 1."""
    low, high = 0.0, 1.0
    def over(lam: float) -> bool:
        return float((shares * np.exp(np.minimum(lam * weights, 700))).sum()) > 1.0
    while not over(high) and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if over(mid) else (mid, high)
    return max(high, 1e-3)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", parts: int = 5, held: int = 0,
        max_rows: int = MAX_LABELLED) -> Model:
    """Fit on the labelled rows of the training folds (see the module)."""
    sample = labelled_sample(labels, id_col, label_col, parts, held, max_rows)
    # At most max_rows rows of an id and a label: the bound of this broadcast.
    rows = (docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_body"))
            .join(F.broadcast(sample), F.col("_doc") == F.col("_id")).select("_y", "_body"))
    n = {r["_y"]: r["n"] for r in rows.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        mean = toxic / max(1, toxic + clean)
        return Model(np.zeros(0, np.int64), np.zeros(0), 1.0, 1.0,
                     float(np.log(max(mean, 1e-9) / max(1 - mean, 1e-9))), 0.0)
    scored = saved(log_odds(token_counts(rows, "_body"), toxic, clean))
    hot = scored.where("weight <> 0").select("bucket", "weight").toPandas()  # at most BUCKETS rows
    step = F.round(F.col("weight") / STEP) * STEP
    hist = scored.groupBy(step.alias("w")).agg(F.sum("n").alias("n")).toPandas()
    weights = hist["w"].to_numpy(dtype=float) - DRIFT
    shares = hist["n"].to_numpy(dtype=float) + 0.5
    shares /= shares.sum()
    lam = decay(weights, shares)
    const = float(np.clip((shares * np.exp(np.minimum(lam * weights, 700)))[weights > 0].sum(), 1e-9, 1.0))
    model = Model(hot["bucket"].to_numpy(dtype=np.int64), hot["weight"].to_numpy(dtype=float),
                  lam, const, 0.0, 0.0)
    # Evidence of the sample, in steps: few rows whatever the sample's size.
    found = evidence(rows, model, {"y": F.col("_y")}, "_body")
    bins = (found.groupBy("y", F.round(scaled(F.col("evidence")), DIGITS).alias("e"))
            .agg(F.count(F.lit(1)).alias("n")).toPandas())
    model.intercept, model.slope = logistic_1d(
        bins["e"].to_numpy(dtype=float), bins["y"].to_numpy(dtype=float),
        bins["n"].to_numpy(dtype=float))
    model.slope = max(model.slope, 0.0)
    return model


def evidence(docs: DataFrame, model: Model, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """Kept columns with n_passages, first (word), last (word) and evidence."""
    lam, const = model.lam, model.const
    shared = docs.sparkSession.sparkContext.broadcast((model.buckets, model.weights))
    held: dict[str, np.ndarray] = {}

    def run(texts: list) -> dict:
        if "t" not in held:
            held["t"] = Model(*shared.value, lam, const, 0.0, 0.0).table()
        out = [passages(t, held["t"], lam, const) for t in texts]
        return {"n_passages": np.array([len(f) for f, _ in out], dtype=np.int32),
                "first_word": np.array([f[0][0] if f else -1 for f, _ in out], dtype=np.int64),
                "last_word": np.array([f[-1][1] if f else -1 for f, _ in out], dtype=np.int64),
                "evidence": np.array([e for _, e in out], dtype=np.float64)}

    return map_texts(docs, text_col, keep, run,
                     "n_passages int, first_word long, last_word long, evidence double")


def scaled(found: Column) -> Column:
    """The evidence as the calibration takes it: its logarithm, so that more
    evidence always scores higher and the largest do not rule the fit."""
    return F.log1p(found)


def probability(model: Model, found: Column) -> Column:
    z = F.lit(model.intercept) + F.lit(model.slope) * scaled(found)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def score_texts(docs: DataFrame, model: Model, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """Kept columns with score, n_passages, first_word, last_word, evidence."""
    return evidence(docs, model, keep, text_col).withColumn("score", probability(model, F.col("evidence")))


def reject_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents whose score is below ``threshold``, columns unchanged;
    texts go to Python once and rows are not shuffled."""
    lam, const = model.lam, model.const
    shared = docs.sparkSession.sparkContext.broadcast((model.buckets, model.weights))
    held: dict[str, np.ndarray] = {}

    @F.pandas_udf("double")
    def found(texts: pd.Series) -> pd.Series:
        if "t" not in held:
            held["t"] = Model(*shared.value, lam, const, 0.0, 0.0).table()
        return pd.Series([passages(t, held["t"], lam, const)[1] for t in texts], dtype="float64")

    packed = docs.select(F.struct("*").alias("_row"), found(text_bytes(text_col)).alias("_evidence"))
    return (packed.where(probability(model, F.col("_evidence")) < threshold)
            .select(*[F.col("_row").getField(c).alias(c) for c in docs.columns]))
