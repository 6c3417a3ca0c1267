"""Small tables for the corpus-operator tests."""

import random

import pyarrow as pa
import pyarrow.parquet as pq

WORDS = [a + b for a in "ka lo mi nu ra se ti vo".split() for b in "ba de fi go hu".split()]
TOXIC = ["idiot", "moron"]


def prose(rng, n, words=WORDS):
    return " ".join(rng.choice(words) for _ in range(n))


def lines(rng, n):
    return "\n".join(prose(rng, rng.randint(3, 9)).capitalize() + "." for _ in range(n))


#: Columns whose names the operators use inside.
EXTRA = ("_row", "_id", "_text", "_hash", "size", "score", "copy", "_size", "text_hash", "n_words", "fp")


def documents(rows, extra=EXTRA):
    """rows: (doc_id, text, lang, source)."""
    cols = {"doc_id": pa.array([r[0] for r in rows], pa.int64()),
            "text": pa.array([r[1] for r in rows], pa.string()),
            "lang": pa.array([r[2] for r in rows], pa.string()),
            "source": pa.array([r[3] for r in rows], pa.string()),
            "n_chars": pa.array([len(r[1] or "") for r in rows], pa.int64())}
    return pa.table(cols | {c: pa.array([f"{c}{i}" for i in range(len(rows))], pa.string()) for c in extra})


def odd_rows(seed=5, n=120):
    """Nulls in every column, empty and blank texts, a very long text, ties,
    repeated rows, copies and near copies."""
    rng = random.Random(seed)
    rows = [(i, lines(rng, rng.randint(1, 12)), rng.choice(["en", "fr", None]),
             rng.choice(["s1", "s2", "s3", None])) for i in range(n)]
    base = rows[3][1]
    rows += [(n + i, base, "en", "s1") for i in range(10)]
    rows += [(n + 20 + i, base + f" tail{i}", "en", "s2") for i in range(5)]
    rows += [(n + 30, None, None, None), (n + 31, "", "en", "s1"), (n + 32, " \t\n ", "fr", "s9"),
             (None, "null id text here", "en", "s1"), (None, "null id text here", "en", "s1"),
             (None, None, None, None), (n + 33, "%%% !!! 123", "en", "s2"),
             (n + 34, prose(rng, 30000), "en", "s2"), (n + 35, "é" * 3000, "fr", "s3"),
             (n + 36, "x", "en", "s3"), (n + 37, rows[5][1] + " idiot moron idiot", "en", "s1")]
    rows += [rows[7], rows[7], rows[8]]
    return rows


def _extra(n, taken, extra=EXTRA):
    return {c: pa.array([f"{c}{i}" for i in range(n)], pa.string()) for c in extra if c not in taken}


#: Columns whose names the operators use inside, for the tables beside documents.
SIDE_EXTRA = (*EXTRA, "_y", "_d", "_v", "v", "cid", "_x", "dim", "code", "error", "item_at", "window", "hash",
              "source", "lang", "n", "doc_id", "vec_id", "label", "kind", "id", "place", "phrase", "f", "words")


def write(folder, docs, labels=None, items=None, vectors=None, vector_labels=None):
    folder.mkdir(parents=True, exist_ok=True)
    labels, items, vectors = labels or [], items or [], vectors or []
    tables = {
        "labels": {"doc_id": pa.array([r[0] for r in labels], pa.int64()),
                   "quality": pa.array([r[1] for r in labels], pa.int32()),
                   "toxic": pa.array([r[2] for r in labels], pa.int32())},
        "benchmark": {"item_id": pa.array([r[0] for r in items], pa.int64()),
                      "text": pa.array([r[1] for r in items], pa.string())},
        "embeddings": {"vec_id": pa.array([r[0] for r in vectors], pa.int64()),
                       "embedding": pa.array([r[1] for r in vectors], pa.list_(pa.float32())),
                       "label": pa.array(vector_labels or [0] * len(vectors), pa.int32())}}
    pq.write_table(docs, folder / "documents.parquet")
    for name, cols in tables.items():
        n = len(next(iter(cols.values())))
        pq.write_table(pa.table(cols | _extra(n, cols, SIDE_EXTRA)), folder / f"{name}.parquet")
    return str(folder)
