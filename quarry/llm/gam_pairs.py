"""Quality classifier: generalised additive model with pairwise interactions.

Each feature of a text is cut into bins at quantiles of the training sample.
The model is a sum of one lookup table per feature and a few two-way tables.
Training cycles over the features; in every round a depth-two tree on one
feature's bins, grown from per-bin sums of gradient and curvature, adds a small
step to that feature's table.  When the single features are done, the pairs
whose two-way grid explains most of what is left get tables the same way.  A
score is the sum of the looked-up entries through the logistic function.

Scale.  Features come from one pass over whole texts (no shuffle of texts) and
are kept as a narrow checkpointed table; only features and ids are joined to
labels.  Bin edges and tables are fitted on at most ``MAX_LABELLED`` labelled
rows, the same on every run; scoring is vectorised bin lookups over Arrow
batches.

Edge cases.  Null and empty texts have all features zero and get the score of
those bins.  Labels other than 0 and 1 are ignored; repeated labels each
count.  Without labels of both classes every score is the label mean (0.5 if
there are none).  Repeated rows are scored alike.  Empty tables give empty
results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import labelled_sample, map_texts, saved

#: Labelled rows used for fitting, at most.
MAX_LABELLED = 40_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1
#: Ridge on leaf values and least curvature of a leaf.
RIDGE, LEAST = 1.0, 2.0

FEATURES = ("words", "chars_per_word", "upper", "digits", "symbols", "blank", "beyond_ascii",
            "distinct_words", "top_word", "repeat_pairs", "lines", "distinct_lines",
            "words_per_line", "symbol_ended", "all_upper", "entropy")

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]] = True
_SYMBOL = ~(_LETTER | _DIGIT | _BLANK | _PLAIN)
_SYMBOL_BYTES = bytes(np.flatnonzero(_SYMBOL).astype(np.uint8))


def features(text: bytes | None) -> list[float]:
    """The values of ``FEATURES`` for one UTF-8 text."""
    if not text:
        return [0.0] * len(FEATURES)
    n = len(text)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    letters = max(1, int(count[_LETTER].sum()))
    words = text.split()
    m = max(1, len(words))
    times = Counter(words)
    lines = text.split(b"\n")
    share = count[count > 0] / n
    ended = sum(c for w, c in times.items() if w[-1:] in _SYMBOL_BYTES)
    upper = sum(c for w, c in times.items() if len(w) > 1 and w.isupper())
    same = sum(map(bytes.__eq__, words, words[1:]))
    return [float(np.log1p(len(words))), n / m, count[_UPPER].sum() / letters,
            count[_DIGIT].sum() / n, count[_SYMBOL].sum() / n, count[_BLANK].sum() / n,
            count[128:].sum() / n, len(times) / m, max(times.values(), default=0) / m, same / m,
            float(np.log1p(len(lines))), len(set(lines)) / len(lines), m / len(lines),
            ended / m, upper / m, float(-(share * np.log2(share)).sum())]


def text_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, features array<double>) for every text."""
    def run(texts: list) -> dict:
        flat = np.array([features(t) for t in texts], dtype=np.float64)
        return {"features": pa.array(list(flat), pa.list_(pa.float64()))}

    return map_texts(docs, text_col, {"doc_id": F.col(id_col)}, run, "features array<double>")


@dataclass
class Model:
    """Bin edges, lookup tables by feature and by pair, and the base log-odds."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (edge, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edge, x[:, j], side="right")]
        coarse = {j: np.searchsorted(self.pair_edges[j], x[:, j], side="right")
                  for j in {j for p in self.pairs for j in p}}
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse[i], coarse[j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def quantile_edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins))


def best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of ordered bins (0: no cut)."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl ** 2 / (hl + RIDGE) + gr ** 2 / (hr + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    gain = np.where((hl >= LEAST) & (hr >= LEAST), gain, 0.0)
    at = int(np.argmax(gain))
    return (float(gain[at]), at + 1) if gain[at] > 1e-9 else (0.0, 0)


def shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf value of every bin in a tree of this depth."""
    gain, cut = best_cut(g, h) if depth else (0.0, 0)
    if not cut:
        return np.full(len(g), g.sum() / (h.sum() + RIDGE))
    return np.concatenate([shallow_tree(g[:cut], h[:cut], depth - 1),
                           shallow_tree(g[cut:], h[cut:], depth - 1)])


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best two-level tree on a grid: one cut of either
    axis, then a cut of the other axis on each side."""
    best, values = 0.0, np.full(g.shape, g.sum() / (h.sum() + RIDGE))
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        for cut in range(1, len(a)):
            gain, parts = 0.0, []
            for part in (slice(None, cut), slice(cut, None)):
                gs, hs = a[part].sum(axis=0), b[part].sum(axis=0)
                parts.append(np.tile(shallow_tree(gs, hs, 1), (len(a[part]), 1)))
                more, _ = best_cut(gs, hs)
                gain += gs.sum() ** 2 / (hs.sum() + RIDGE) + more
            gain -= g.sum() ** 2 / (h.sum() + RIDGE)
            if gain > best:
                grid = np.concatenate(parts)
                best, values = gain, grid.T if turned else grid
    return best, values


def fit_tables(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of the single tables, then of the chosen pairs."""
    mean = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
    model = Model(base=float(np.log(mean / (1 - mean))))
    if not len(y) or y.min() == y.max():
        return model
    d = x.shape[1]
    model.edges = [quantile_edges(x[:, j], BINS) for j in range(d)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    z = np.full(len(y), model.base)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(d):
            g, h = gradients()
            size = len(model.tables[j])
            step = RATE * shallow_tree(np.bincount(bins[j], g, size), np.bincount(bins[j], h, size))
            model.tables[j] += step
            z += step[bins[j]]
    model.pair_edges = [quantile_edges(x[:, j], PAIR_BINS) for j in range(d)]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.pair_edges)]

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        a, b = len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1
        return np.bincount(coarse[i] * b + coarse[j], v, a * b).reshape(a, b)

    g, h = gradients()
    gains = sorted(((pair_tree(grid(i, j, g), grid(i, j, h))[0], i, j)
                    for i in range(d) for j in range(i + 1, d)), key=lambda t: (-t[0], t[1], t[2]))
    model.pairs = [(i, j) for gain, i, j in gains[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1))
                         for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for table, (i, j) in zip(model.pair_tables, model.pairs, strict=True):
            g, h = gradients()
            step = RATE * pair_tree(grid(i, j, g), grid(i, j, h))[1]
            table += step
            z += step[coarse[i], coarse[j]]
    return model


def fit(table: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        parts: int = 5, held: int = 0, max_rows: int = MAX_LABELLED) -> Model:
    """Fit on the labelled rows of the training folds; ``table`` is the result
    of :func:`text_features`."""
    sample = labelled_sample(labels, id_col, label_col, parts, held, max_rows)
    # At most max_rows rows of an id and a label: the bound of this broadcast,
    # and (ids being unique) of what reaches the driver.
    rows = (table.join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
            .select("_id", "_y", "features").orderBy("_id", "_y").limit(max_rows).toPandas())
    x = np.array(rows["features"].tolist(), dtype=np.float64).reshape(len(rows), len(FEATURES))
    return fit_tables(x, rows["_y"].to_numpy(dtype=np.float64))


def score_column(model: Model, features_col: Column) -> Column:
    """Score of a features array, by vectorised lookups."""
    @F.pandas_udf("double")
    def lookup(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            x = np.array(s.tolist(), dtype=np.float64).reshape(len(s), len(FEATURES))
            yield pd.Series(model.score(x))

    return lookup(features_col)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", parts: int = 5, held: int = 0,
                  max_rows: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, score) for every document."""
    table = saved(text_features(docs, id_col, text_col))
    model = fit(table, labels, id_col, label_col, parts, held, max_rows)
    return table.select("doc_id", score_column(model, F.col("features")).alias("score"))
