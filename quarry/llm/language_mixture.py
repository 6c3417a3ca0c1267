"""Language identification by multilingual mixture inference.

Every language with training text gets a smoothed distribution over hashed
byte trigrams.  A document is a mixture: each of its trigrams comes from one of
the languages, with the document's proportions.  Expectation-maximisation
estimates the proportions; the set of languages is chosen by penalised
likelihood (each further language must raise the log-likelihood by more than
``PENALTY`` times the log of the number of trigrams).  The prediction is the
language with the largest proportion in the chosen set.

Scale.  Training counts every training text once; tasks send one row per
(language, trigram bucket) they saw, summed by a partial aggregate, so the
counts cover the whole corpus.  The model keeps the buckets a language has met,
at most ``BUCKETS`` per language, whatever the corpus; any number of languages
is inferred over at once.  Scoring reads every text once and shuffles nothing.

Edge cases.  Null texts and texts without a letter are ``und`` with score 0,
as is everything if nothing could be learned.  Languages equal in proportion:
the first by name.  Texts shorter than a trigram are padded with blanks.
Repeated rows are predicted alike.  Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import map_texts, text_bytes

BUCKETS = 1 << 15
#: Pseudo-count of every bucket.
SMOOTH = 0.1
PENALTY = 2.0
ROUNDS = 25
#: A proportion step below this ends the iteration.
TOLERANCE = 1e-3
#: ASCII bytes other than letters become blanks.
LETTER_BYTES = bytes(c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_LETTER = re.compile(r"[^\W\d_]")


def trigram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the byte trigrams of the lower-cased letters, words
    set off by single blanks."""
    words = text.lower().encode().translate(LETTER_BYTES).split()
    a = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    if len(a) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:]
    h = (code * np.uint32(2654435761)) >> np.uint32(32 - 15)
    counts = np.bincount(h, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


@dataclass
class Model:
    """Languages by name and their log-probabilities: ``unseen`` per language,
    and by bucket (``start`` to the next) the languages that have met it with
    their value.  A language has at most ``BUCKETS`` entries, so any number of
    languages has room for what it has learnt."""

    langs: list[str]
    unseen: np.ndarray
    start: np.ndarray
    lang: np.ndarray
    value: np.ndarray

    def log_p(self, at: np.ndarray) -> np.ndarray:
        """Log-probabilities of these buckets (rows) by language."""
        out = np.repeat(self.unseen[None], len(at), axis=0)
        n = self.start[at + 1] - self.start[at]
        entry = np.repeat(self.start[at] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        out[np.repeat(np.arange(len(at)), n), self.lang[entry]] = self.value[entry]
        return out


def fit(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from the rows where ``train`` holds and lang is not null."""
    rows = (docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(lang_col).cast("string").alias("lang"), text_bytes(text_col).alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                at, n = trigram_counts(t.decode("utf-8", "replace"))
                if lang not in sums:
                    sums[lang] = np.zeros(BUCKETS, np.int64)
                sums[lang][at] += n
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])],
                names=["lang", "bucket", "n"])

    counts = (rows.mapInArrow(run, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    found = counts.toPandas()  # at most BUCKETS rows per language
    langs = sorted(found["lang"].unique().tolist())
    place = {name: i for i, name in enumerate(langs)}
    lang = found["lang"].map(place).to_numpy(dtype=np.int64)
    bucket, n = found["bucket"].to_numpy(dtype=np.int64), found["n"].to_numpy(dtype=np.float64) + SMOOTH
    unseen = np.bincount(lang, minlength=len(langs))
    total = np.bincount(lang, weights=n, minlength=len(langs)) + SMOOTH * (BUCKETS - unseen)
    order = np.lexsort((lang, bucket))
    start = np.zeros(BUCKETS + 1, np.int64)
    np.cumsum(np.bincount(bucket, minlength=BUCKETS), out=start[1:])
    return Model(langs, np.log(SMOOTH / total) if langs else np.zeros(0), start, lang[order],
                 np.log(n / total[lang])[order])


def proportions(p: np.ndarray, counts: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, float]:
    """EM: the mixture weights of the columns of ``p`` and the log-likelihood."""
    pi, total = start, counts.sum()
    for _ in range(ROUNDS):
        mix = p @ pi
        new = pi * ((counts / mix) @ p) / total
        done = np.abs(new - pi).max() < TOLERANCE
        pi = new
        if done:
            break
    return pi, float(counts @ np.log(p @ pi))


def infer(log_p: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Proportions over all languages, zero outside the chosen set."""
    n_langs, total = log_p.shape[1], int(counts.sum())
    # Scaled per trigram, which changes no proportion and avoids underflow.
    top = log_p.max(axis=1, keepdims=True)
    p, shift = np.exp(log_p - top), float(counts @ top[:, 0])
    single = counts @ log_p
    out = np.zeros(n_langs)
    first = int(np.argmax(single))
    if n_langs == 1 or total < 2:
        out[first] = 1.0
        return out
    share, _ = proportions(p, counts, np.full(n_langs, 1.0 / n_langs))
    order = [first] + [j for j in np.argsort(-share, kind="stable").tolist() if j != first]
    cost = PENALTY * np.log(total)
    chosen, weights, best = [first], np.ones(1), float(single[first])
    for size in range(2, n_langs + 1):
        tried = order[:size]
        pi, fit_ = proportions(p[:, tried], counts, np.full(size, 1.0 / size))
        if fit_ + shift - best <= cost:
            break
        chosen, weights, best = tried, pi, fit_ + shift
    out[chosen] = weights / weights.sum()
    return out


def predict(docs: DataFrame, model: Model, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """Kept columns with lang_pred, score (its proportion) and langs (the
    chosen set, comma-joined)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def one(text: bytes | None) -> tuple[str, float, str]:
        langs = shared.value.langs
        words = "" if text is None else text.decode("utf-8", "replace")
        if not langs or not _LETTER.search(words):
            return "und", 0.0, ""
        at, counts = trigram_counts(words)
        if not len(at):
            return "und", 0.0, ""
        share = infer(shared.value.log_p(at), counts)
        k = int(np.argmax(share))
        return langs[k], float(share[k]), ",".join(langs[j] for j in np.flatnonzero(share > 0))

    def run(texts: list) -> dict:
        out = [one(t) for t in texts]
        return {"lang_pred": pa.array([x[0] for x in out], pa.string()),
                "score": np.array([x[1] for x in out], dtype=np.float64),
                "langs": pa.array([x[2] for x in out], pa.string())}

    return map_texts(docs, text_col, keep, run, "lang_pred string, score double, langs string")
