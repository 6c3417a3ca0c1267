"""Token ids in flat binary files.

A corpus is written as shards in ascending id order.  Shard k has three flat
little-endian files without headers::

    shard-00000k.bin   token ids, unsigned 16 bit (32 bit for larger vocabularies)
    shard-00000k.off   unsigned 64-bit offsets: where each document's ids begin
                       within the shard, and the shard's end
    shard-00000k.doc   signed 64-bit document ids

``manifest.json`` names the type and every shard's bases, the number of ids
and of documents before it, which are prefix sums of the shards' counts.  So
document d of a shard starts at ``base + off[d]`` in the corpus and any of it
can be memory-mapped without reading the rest.

Scale.  One range exchange brings the texts into order; each task then encodes
its texts in slices and appends to its own shard, so memory follows the
longest slice, and the driver sees one row of counts per shard.  Equal ids (a
third of all rows without one, say) are spread by their text and place, so
they do not share a task.  A shard is written under the attempt's own name and
moved into place when complete: a task that runs again after its executor is
lost writes the same shard.  Files go through Arrow's file systems, to the
shared folder.

Words are encoded once per worker: this kind of tokenizer drops white space,
so a text's ids are those of its blank-separated words in turn, and a word met
before is a look-up.  Tokenizers of another kind get whole texts.

Edge cases.  Null text is the empty text: the end id alone.  Null ids come
last; the manifest counts them.  Rows with equal ids are ordered by the hash
of their text; equal rows have a place each.  Ids must be integers.  An empty
table has no shards.  Further columns are ignored.
"""

from __future__ import annotations

import functools
import json
import os
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.token_cache import file_digest
from quarry.session import shared_dir

#: Words a task remembers, and the longest of them (bytes).
WORDS, WORD_BYTES = 500_000, 64
# Fixed value: the splitter's pieces of a text.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Ids read at once when a file is not memory-mapped or a document is long.
BLOCK = 1 << 20


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system and the path in it for a Hadoop-style path."""
    if re.match(r"[a-z][a-z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def id_type(vocabulary: int) -> str:
    """Flat type for ids below ``vocabulary``."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def byte_letters() -> str:
    """The letters that byte-level vocabularies write for the 256 bytes: a
    byte that is a visible Latin-1 sign stands for itself, the others take the
    code points from 256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = iter(range(256, 512))
    return "".join(chr(b if b in visible else next(others)) for b in range(256))


class WordIds(dict):
    """Flat ids of blank-separated words.  A word of Latin letters, then signs,
    is two pieces for the splitter (``PLAIN``), which go to the model as they
    are; any other word goes through the whole library.  Pieces met before are
    look-ups."""

    #: Letters that are one code point each in every normal form, in either
    #: case, then signs without the apostrophe, which starts pieces of its own.
    PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")

    def __init__(self, tokenizer, dtype: str):
        super().__init__()
        self.encode = lambda w: tokenizer.encode(w, add_special_tokens=False).ids
        self.model, self.dtype, self.pieces = tokenizer.model, dtype, {}
        self.letters = dict(zip(map(chr, range(256)), byte_letters(), strict=True))
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def piece(self, text: str) -> bytes:
        ids = self.pieces.get(text)
        if ids is None:
            letters = text if text.isascii() else "".join(
                map(self.letters.__getitem__, text.encode().decode("latin-1")))
            ids = np.array([t.id for t in self.model.tokenize(letters)], dtype=self.dtype).tobytes()
            if len(text) <= WORD_BYTES:
                self.pieces[text] = ids
        return ids

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        m = self.PLAIN.fullmatch(text)
        if m is None or any(s in text for s in self.special):
            ids = np.array(self.encode(text), dtype=self.dtype).tobytes()
        else:
            ids = b"".join(self.piece(p) for p in (m[1].lower(), m[2]) if p)
        if len(word) <= WORD_BYTES:
            self[word] = ids
        return ids

    def flat(self, text: bytes) -> bytes:
        if len(self) > WORDS:
            self.clear()
        if len(self.pieces) > WORDS:
            self.pieces.clear()
        return b"".join(map(self.__getitem__, text.split()))


@functools.lru_cache(maxsize=1)
def load_flat_encoder(name: str, version: str, dtype: str) -> Callable[[bytes], bytes]:
    """From UTF-8 text to flat ids, with a tokenizer file ``addFile`` shipped
    (``version`` is its digest).  A worker process keeps it between tasks."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(SparkFiles.get(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    if drops_blanks(tokenizer.to_str()):
        return WordIds(tokenizer, dtype).flat
    return lambda text: np.array(tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids,
                                 dtype=dtype).tobytes()


def drops_blanks(tokenizer_json: str) -> bool:
    """Whether no token can depend on the blanks around a word: white space
    becomes one space, letters small, the pieces are ``PIECES``, what is between
    them is removed, and no added token reaches over blanks."""
    t = json.loads(tokenizer_json)
    steps = (t.get("normalizer") or {}).get("normalizers") or []
    splits = (t.get("pre_tokenizer") or {}).get("pretokenizers") or []
    one_space = any(s["type"] == "Replace" and s["pattern"].get("Regex") == "\\s+" and s["content"] == " "
                    for s in steps)
    known = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
    pieces = (len(splits) == 2 and splits[0]["type"] == "Split" and splits[0]["behavior"] == "Removed"
              and splits[0]["invert"] and splits[0]["pattern"].get("Regex") == PIECES
              and splits[1]["type"] == "ByteLevel" and not splits[1]["add_prefix_space"]
              and not splits[1]["use_regex"])
    apart = not any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] or " " in a["content"]
                    for a in t.get("added_tokens") or [])
    return bool(one_space and known and pieces and apart and not t.get("post_processor"))


def write_token_files(docs: DataFrame, tokenizer_path: str, path: str, end_id: int | None = None,
                      id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> dict:
    """Write the shards and the manifest below ``path``; returns the manifest.
    ``end_id`` is appended to each document; ``shards`` defaults to the
    session's shuffle partitions (encoding is work, so few bytes are not
    merged into few tasks)."""
    from tokenizers import Tokenizer
    spark = docs.sparkSession
    dtype = id_type(max(Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True),
                        (end_id or 0) + 1))
    spark.sparkContext.addFile(tokenizer_path)
    name, version = os.path.basename(tokenizer_path), file_digest(tokenizer_path)
    end = b"" if end_id is None else np.array([end_id], dtype=dtype).tobytes()
    width = np.dtype(dtype).itemsize
    narrow = docs.select(F.col(id_col).isNull().alias("no_id"), F.col(id_col).cast("long").alias("id"),
                         F.xxhash64(text_col).alias("hash"), F.monotonically_increasing_id().alias("place"),
                         F.col(text_col).cast("binary").alias("text"))
    keys = ["no_id", "id", "hash", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        task = TaskContext.get()
        shard, attempt = task.partitionId(), task.taskAttemptId()
        where, base = file_system(path)
        temp = f"{base}/_attempt-{shard:06d}-{attempt}"
        encode = load_flat_encoder(name, version, dtype)
        out, counts, ids, nulls = None, [], [], 0
        try:
            for b in batches:
                if not b.num_rows:
                    continue
                if out is None:
                    out = where.open_output_stream(f"{temp}.bin")
                for raw in b.column(b.schema.get_field_index("text")):
                    flat = encode(raw.as_py() or b"") + end
                    counts.append(len(flat) // width)
                    out.write(flat)
                own = b.column(b.schema.get_field_index("id"))
                nulls += own.null_count
                ids.append(own.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        finally:
            if out is not None:
                out.close()
        if out is None:
            return
        offsets = np.zeros(len(counts) + 1, dtype="<u8")
        np.cumsum(counts, out=offsets[1:])
        for kind, data in (("off", offsets), ("doc", np.concatenate(ids))):
            with where.open_output_stream(f"{temp}.{kind}") as f:
                f.write(data.tobytes())
        for kind in ("bin", "off", "doc"):
            where.move(f"{temp}.{kind}", f"{base}/shard-{shard:06d}.{kind}")
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], pa.int64()) for x in (shard, len(counts), nulls, int(offsets[-1]))],
            names=["shard", "docs", "nulls", "tokens"])

    where, base = file_system(path)
    where.create_dir(base, recursive=True)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (narrow.repartitionByRange(shards, *keys).sortWithinPartitions(*keys)
            .select("id", "text").mapInArrow(run, "shard long, docs long, nulls long, tokens long").collect())
    return write_manifest(path, dtype, rows)


def write_manifest(path: str, dtype: str, rows: list) -> dict:
    """Bases by prefix sums over the shards' counts (one row per shard)."""
    rows = sorted(rows)
    docs = np.cumsum([0, *(r["docs"] for r in rows)])
    tokens = np.cumsum([0, *(r["tokens"] for r in rows)])
    manifest = {"type": dtype, "docs": int(docs[-1]), "tokens": int(tokens[-1]), "shards": [
        {"name": f"shard-{r['shard']:06d}", "docs": r["docs"], "nulls": r["nulls"], "tokens": r["tokens"],
         "doc_base": int(d), "token_base": int(t)} for r, d, t in zip(rows, docs, tokens, strict=False)]}
    where, base = file_system(path)
    with where.open_output_stream(f"{base}/manifest.json") as f:
        f.write(json.dumps(manifest).encode())
    return manifest


def read_manifest(path: str) -> dict:
    where, base = file_system(path)
    with where.open_input_stream(f"{base}/manifest.json") as f:
        return json.loads(f.read())


class Shard:
    """One shard's files: memory-mapped where the file system is a mounted
    one, read in ranges otherwise."""

    def __init__(self, path: str, name: str, dtype: str):
        self.where, base = file_system(path)
        self.base, self.name, self.dtype = base, name, np.dtype(dtype)
        self.local = isinstance(self.where, fs.LocalFileSystem)
        self.offsets = self._whole("off", "<u8")
        self.doc_ids = self._whole("doc", "<i8")
        self.ids = self._whole("bin", dtype) if self.local else None
        self.file = None if self.local else self.where.open_input_file(f"{base}/{name}.bin")

    def _whole(self, kind: str, dtype: str) -> np.ndarray:
        path = f"{self.base}/{self.name}.{kind}"
        if not self.local:
            with self.where.open_input_stream(path) as f:
                return np.frombuffer(f.read(), dtype=dtype)
        if not os.path.getsize(path):
            return np.zeros(0, dtype)
        return np.memmap(path, dtype=dtype, mode="r")

    def span(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo..hi of the shard."""
        if self.local:
            return self.ids[lo:hi]
        w = self.dtype.itemsize
        return np.frombuffer(self.file.read_at((hi - lo) * w, lo * w), dtype=self.dtype)

    def document(self, d: int) -> np.ndarray:
        """Ids of the shard's document d."""
        return self.span(int(self.offsets[d]), int(self.offsets[d + 1]))

    def crc32(self, d: int) -> int:
        """crc32 of a document's ids as little-endian unsigned 32-bit integers."""
        lo, hi, crc = int(self.offsets[d]), int(self.offsets[d + 1]), 0
        for at in range(lo, hi, BLOCK):
            crc = zlib.crc32(self.span(at, min(hi, at + BLOCK)).astype("<u4").tobytes(), crc)
        return crc


def document(path: str, manifest: dict, at: int) -> np.ndarray:
    """Ids of the corpus's document number ``at``, by its shard's base."""
    bases = [s["doc_base"] for s in manifest["shards"]]
    k = int(np.searchsorted(bases, at, "right")) - 1
    return Shard(path, manifest["shards"][k]["name"], manifest["type"]).document(at - bases[k])


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document of the files: id, start (ids of all documents
    before it), n_tokens and ids_crc32.  One task per shard."""
    manifest = read_manifest(path)
    shards, dtype = manifest["shards"], manifest["type"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in b.column(0).to_pylist():
                entry = shards[k]
                shard = Shard(path, entry["name"], dtype)
                off = np.asarray(shard.offsets).astype(np.int64)
                known = entry["docs"] - entry["nulls"]
                for lo in range(0, entry["docs"], 16_384):
                    hi = min(entry["docs"], lo + 16_384)
                    none = np.arange(lo, hi) >= known  # null ids are last
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.asarray(shard.doc_ids[lo:hi]), mask=none),
                         pa.array(entry["token_base"] + off[lo:hi]), pa.array(np.diff(off[lo:hi + 1])),
                         pa.array([shard.crc32(d) for d in range(lo, hi)], pa.int64())],
                        names=[id_col, "start", "n_tokens", "ids_crc32"])

    n = len(shards)
    return spark.range(0, n, 1, max(1, n)).mapInArrow(
        run, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long")


def new_folder(spark: SparkSession) -> str:
    """A fresh folder for token files in the shared folder."""
    return shared_dir(spark, "token_files", uuid.uuid4().hex)
