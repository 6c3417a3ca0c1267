"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

#: Letters A-Z, the only ones a contract lower-cases.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()

#: Words separated by the ASCII blanks space, tab, LF, VT, FF and CR.
BLANK_WORD = r"[^\x20\x09-\x0D]+"


def saved(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder (reliable
    ``checkpoint()``), so later branches read it instead of the source."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (null id: null)."""
    return F.crc32(F.col(id_col).cast("string")) % F.lit(parts)


def held_out(id_col: str, parts: int, remainder: int) -> Column:
    """Whether the id falls in the held-out remainder (null id: no)."""
    return F.coalesce(fold(id_col, parts) == F.lit(remainder), F.lit(False))


def text_bytes(text_col: str) -> Column:
    """The text as UTF-8 bytes, so Python tasks get bytes without decoding."""
    return F.col(text_col).cast("binary")


def map_texts(df: DataFrame, text_col: str, keep: dict[str, Column],
              fn: Callable[[list], dict[str, np.ndarray | list]],
              out_schema: str, batch: int = 512) -> DataFrame:
    """Kept columns plus the columns ``fn`` returns for the texts.

    ``fn`` gets a list of UTF-8 byte strings (or None) and returns one array
    per output column named in ``out_schema`` ("a double, b long").  Runs in
    ``mapInArrow`` over slices of ``batch`` rows; nothing is held between
    slices, so memory follows the longest slice, not the partition.
    """
    narrow = df.select(*[c.alias(n) for n, c in keep.items()],
                       text_bytes(text_col).alias("_text"))
    kept_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                            for f in narrow.schema.fields if f.name != "_text")
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, batch):
                part = whole.slice(at, batch)
                new = fn(part.column(part.schema.get_field_index("_text")).to_pylist())
                arrays = [part.column(part.schema.get_field_index(n)) for n in names]
                yield pa.RecordBatch.from_arrays(
                    arrays + [v if isinstance(v, pa.Array) else pa.array(v) for v in new.values()],
                    names=names + list(new))

    return narrow.mapInArrow(run, f"{kept_schema}, {out_schema}")


def labelled_sample(labels: DataFrame, id_col: str, label_col: str, parts: int,
                    held: int, max_rows: int) -> DataFrame:
    """At most ``max_rows`` labelled rows (``_id``, ``_y``) of the training
    folds, the same ones on every run (smallest id hashes).  The bound is what
    makes broadcasting the sample safe.

    Rows above a threshold of the hash, chosen from the number of rows, are
    left out before anything is sorted; it is raised until it lets enough rows
    through.  So a sort meets little more than ``max_rows`` rows, however many
    tasks read the labels.  Repeated rows meet as counts and each comes as
    often as it stands in ``labels``."""
    y = F.col(label_col).cast("int")
    hashed = F.xxhash64("_id")
    rows = (labels.where(y.isin(0, 1) & F.col(id_col).isNotNull())
            .where(fold(id_col, parts) != held)
            .select(F.col(id_col).alias("_id"), y.alias("_y")))
    share = 1.5 * max_rows / max(1, rows.count())
    while share < 1:
        near = rows.where(hashed <= F.lit(int(share * 2**64) - 2**63))
        if near.count() >= max_rows:
            rows = near
            break
        share *= 2
    copies = F.sequence(F.lit(1), F.least(F.count(F.lit(1)), F.lit(max_rows)))
    return (rows.groupBy("_id", "_y").agg(copies.alias("_copies"))
            .select("_id", "_y", F.explode("_copies"))
            .orderBy(hashed, "_id", "_y").limit(max_rows).select("_id", "_y"))


def logistic_1d(x: np.ndarray, y: np.ndarray, weight: np.ndarray,
                ridge: float = 1e-3, steps: int = 50) -> tuple[float, float]:
    """Intercept and slope of a one-feature logistic regression (Newton)."""
    a, b = 0.0, 0.0
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(a + b * x, -30, 30)))
        w = weight * np.maximum(p * (1 - p), 1e-9)
        g = np.array([(weight * (y - p)).sum() - ridge * a,
                      (weight * (y - p) * x).sum() - ridge * b])
        h = np.array([[w.sum() + ridge, (w * x).sum()],
                      [(w * x).sum(), (w * x * x).sum() + ridge]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5.0 / max(1e-12, float(np.abs(step).max())))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def rows_in_key_runs(batches: Iterable[pa.RecordBatch], keys: list[str]
                     ) -> Iterator[tuple[tuple, dict[str, np.ndarray]]]:
    """Group consecutive rows of equal ``keys`` (input sorted by them) and
    yield (key values, numpy columns).  Only one group is held at a time."""
    held: list[pa.RecordBatch] = []
    current: tuple | None = None

    def emit() -> tuple[tuple, dict[str, np.ndarray]]:
        t = pa.Table.from_batches(held)
        return current, {n: (c.to_numpy() if not pa.types.is_nested(c.type) else c.combine_chunks())
                         for n, c in zip(t.column_names, t.columns, strict=True)}

    for b in batches:
        n = b.num_rows
        if not n:
            continue
        ks = [b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(n, dtype=bool)
        for k in ks:
            change[1:] |= k[1:] != k[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), n]
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            key = tuple(k[lo].item() for k in ks)
            if current is not None and key != current:
                yield emit()
                held = []
            current = key
            held.append(b.slice(lo, hi - lo))
    if held:
        yield emit()
