"""Token counts through a digest cache.

The cache is a table (tokenizer digest, content digest, n_bytes, n_tokens) in
the shared folder.  A corpus is reduced to its distinct contents by SHA-256,
joined to the cache under the tokenizer's own digest (SHA-256 of its file), and
only distinct contents without an entry are encoded and appended; the counts
then come from the cache for every document.  A new tokenizer version has a
new digest and never sees old counts.

Scale.  Distinct contents are found by a partial aggregate, so a text copied
into a third of the corpus crosses the shuffle once per task; the encoder runs
on the result of that same shuffle.  The final join is on digests only, with
the cache side as a scan, so a hot digest can be split.  An append is one
Spark write: tasks may be retried, and an entry written twice by two
concurrent runs is read once.

Edge cases.  Null text counts as the empty text (0 bytes, 0 tokens).  Texts
are encoded whole, in slices of bounded size, without special tokens added;
special strings inside texts are treated as the library does by default.
Repeated rows share one entry and keep a row each.  An empty table appends
nothing and gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import saved
from quarry.session import shared_dir

CACHE_SCHEMA = "tokenizer string, digest binary, n_bytes long, n_tokens long"
#: Bytes of text encoded in one call of the library.
SLICE_BYTES = 1 << 20
#: Chunk counts a task remembers before it starts over.
CHUNKS = 500_000


def content(text_col: str) -> Column:
    """Normalised content: null is the empty text, all else as it is (any
    other change could change the count)."""
    return F.coalesce(F.col(text_col), F.lit(""))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def file_digest(path: str) -> str:
    """The tokenizer's version: SHA-256 of its file."""
    h = hashlib.sha256()
    with open(path, "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            h.update(block)
    return h.hexdigest()


def load_encoder(name: str) -> Callable[[list[str]], list[int]]:
    """Token counter of whole texts from a tokenizer file that ``addFile``
    shipped: .json by tokenizers, .model by sentencepiece."""
    path = SparkFiles.get(name)
    if name.endswith(".json"):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

        def encode(texts: list[str]) -> list[int]:
            return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

        byte_level = (tokenizer.normalizer is None and "ByteLevel" in str(tokenizer.pre_tokenizer)
                      and "add_prefix_space=False" in str(tokenizer.pre_tokenizer))
        return ChunkCounts(tokenizer, encode, special).count if byte_level else encode
    import sentencepiece
    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]


class ChunkCounts(dict):
    """Token counts of chunks for byte-level tokenizers, which never join a
    word to a following blank: a text whose blanks are single spaces or line
    feeds between words is the sum of its chunks (a blank and a word), and a
    chunk met before need not be tokenized again.  A new chunk goes through the
    library's splitter and model; one of ASCII letters, then marks, is known to
    be one word of the model for each (its blank written U+0120, as byte-level
    vocabularies do) and spares the splitter.  Texts with other blanks, or a
    special string, are encoded whole."""

    chunk = re.compile(r"[ \n]?[^ \n]+")
    plain = re.compile(r"( ?)([A-Za-z]+)([!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]*)")
    blank = re.compile(r"[^\S \n]|[\x1c-\x1f]")

    def __init__(self, tokenizer, encode: Callable[[list[str]], list[int]], special: list[str]):
        super().__init__()
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        self.tokenize = tokenizer.model.tokenize
        self.encode, self.special = encode, special

    def __missing__(self, c: str) -> int:
        m = self.plain.fullmatch(c)
        if m is None:
            words = [w for w, _ in self.split(c)]
        else:
            words = [("\u0120" if m[1] else "") + m[2]] + ([m[3]] if m[3] else [])
        self[c] = n = sum(len(self.tokenize(w)) for w in words)
        return n

    def regular(self, t: str) -> bool:
        return not ("  " in t or "\n\n" in t or " \n" in t or "\n " in t or t[:1] in (" ", "\n")
                    or t[-1:] in (" ", "\n") or any(x in t for x in self.special)
                    or self.blank.search(t))

    def count(self, texts: list[str]) -> list[int]:
        if len(self) > CHUNKS:
            self.clear()
        return [sum(map(self.__getitem__, self.chunk.findall(t))) if self.regular(t)
                else self.encode([t])[0] for t in texts]


def encode_counts(texts: DataFrame, tokenizer_path: str, version: str) -> DataFrame:
    """Cache rows for distinct contents (digest, text)."""
    spark = texts.sparkSession
    spark.sparkContext.addFile(tokenizer_path)
    name = tokenizer_path.rsplit("/", 1)[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        count = load_encoder(name)
        for whole in batches:
            digests, values = whole.column(0), whole.column(1)
            at = 0
            while at < whole.num_rows:
                upto, size, part = at, 0, []
                while upto < whole.num_rows and (not part or size < SLICE_BYTES):
                    part.append(values[upto].as_py())
                    size += len(part[-1])
                    upto += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([version] * len(part)), digests.slice(at, len(part)),
                     pa.array([len(x.encode()) for x in part], pa.int64()),
                     pa.array(count(part), pa.int64())],
                    names=["tokenizer", "digest", "n_bytes", "n_tokens"])
                at = upto

    return texts.select("digest", "text").mapInArrow(run, CACHE_SCHEMA)


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """The cache's entries of one tokenizer version (none if no table yet)."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    cache = (spark.read.schema(CACHE_SCHEMA).parquet(path) if there
             else spark.createDataFrame([], CACHE_SCHEMA))
    return cache.where(F.col("tokenizer") == version).drop("tokenizer")


def new_cache(spark: SparkSession) -> str:
    """Path of a fresh cache in the shared folder."""
    return shared_dir(spark, "token_cache", uuid.uuid4().hex)


def fill_cache(docs: DataFrame, tokenizer_path: str, cache_path: str,
               text_col: str = "text") -> DataFrame:
    """Encode the distinct contents the cache lacks, append them, and return
    the cache's entries for this tokenizer."""
    spark, version = docs.sparkSession, file_digest(tokenizer_path)
    distinct = (docs.select(content(text_col).alias("text"))
                .withColumn("digest", digest(F.col("text"))).dropDuplicates(["digest"]))
    misses = distinct.join(read_cache(spark, cache_path, version), "digest", "left_anti")
    encode_counts(misses, tokenizer_path, version).write.mode("append").parquet(cache_path)
    # Saved, so that the join to the documents has two plain exchanges and a
    # digest that many documents share can be split.
    return saved(read_cache(spark, cache_path, version).dropDuplicates(["digest"]))


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) per document.  ``cache_path`` names a cache to
    use and extend; without one a fresh cache is made."""
    spark = docs.sparkSession
    entries = fill_cache(docs, tokenizer_path, cache_path or new_cache(spark), text_col)
    ids = docs.select(F.col(id_col), digest(content(text_col)).alias("_digest"))
    return (ids.join(entries.withColumnRenamed("digest", "_d"), F.col("_digest") == F.col("_d"))
            .select(id_col, "n_bytes", "n_tokens"))
