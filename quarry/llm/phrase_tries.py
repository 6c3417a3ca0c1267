"""Phrase collocations by level-wise tries.

Texts are cut into pieces and words; phrases are counted per language, within
pieces.  Level by level, candidates of one more word come only from phrases
whose parts without the last and without the first word are frequent
themselves (Apriori).  The candidates become tries of sorted edges, which are
broadcast; a task holds its texts as one array of word codes and moves the
states of all text positions one word further at a time, with one search among
a level's edges per word.  Accepting states are counted with ``bincount`` and the
tasks' counts are added up.

Where candidates come from: the pass that counts one level also counts the
words that follow its accepted phrases, as pairs of the phrase's number and a
32-bit hash of the word, packed into one integer.  Pairs met at least
``min_count`` times, with the frequent words of that hash and with a frequent
phrase behind the first word, are the next candidates.  Equal hashes can only
add to a pair's count or add candidates, so nothing frequent is lost; the tries
then count the candidates exactly.

Scale.  Frequent phrases are tables, never whole on the driver.  A trie holds
at most ``TRIE`` phrases: that many are collected, built and broadcast at once,
and more candidates mean more tries and passes (dealt by hash), not larger ones.
Building one is a sort per level, whatever the number of words.
Texts are read anew by every pass and never shuffled; what travels is a row of
two integers per distinct pair and task, so it grows no faster than the texts.  A
word or phrase in a third of all texts is one row per task.  A task's memory
follows its batch of texts, one trie and the pairs it holds, which are written
out whenever there are more than ``HELD``.

Scores are exact (decimals of 38 digits hold the products for up to 10**15
words).  Edge cases.  Null text has no words; a null language is ``und``, as
is that name itself.  Long texts are walked whole.  Repeated rows count as
often as they come.  An empty table, or one without frequent phrases, gives an
empty result.  Further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm.common import saved

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
#: Phrases of one trie.
TRIE = 500_000
#: Counted words or pairs a task holds before it writes them out.
HELD = 2_000_000
#: Bytes of text walked at once (a longer text is walked alone).
SLICE_BYTES = 1 << 22
BREAK = b"."
#: The low 32 bits of an integer.
HALF = 0xFFFFFFFF
#: Lower-cases A-Z and makes every end of a piece the same byte.
_TABLE = bytes(46 if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_and_breaks(text: bytes) -> list[bytes]:
    """Words in order, with ``BREAK`` between pieces."""
    return text.translate(_TABLE).replace(BREAK, b" . ").split()


def text_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(language, joined texts): texts of one language, about ``SLICE_BYTES``
    at a time, a piece's end between any two."""
    for b in batches:
        langs, texts = b.column(0).to_pylist(), b.column(1)
        held: dict[str, list[bytes]] = {}
        size: Counter = Counter()
        for i, lang in enumerate(langs):
            raw = texts[i].as_py()
            if not raw:
                continue
            held.setdefault(lang, []).append(raw)
            size[lang] += len(raw)
            if size[lang] >= SLICE_BYTES:
                yield lang, b"\n".join(held.pop(lang))
                size[lang] = 0
        for lang, raws in held.items():
            yield lang, b"\n".join(raws)


class Trie(NamedTuple):
    """A trie as its sorted edges.  ``check`` has an edge for each state: the
    state it leaves in the upper, the word's code in the lower 32 bits; states
    are numbered by their edges, behind the ``roots``, which are the languages'
    first states.  Level d's edges begin at ``starts[d]``, and ``phrase`` is the
    number of the phrase accepted in each of ``accepts``."""

    codes: dict[bytes, int]
    roots: dict[str, int]
    check: np.ndarray
    starts: np.ndarray
    accepts: np.ndarray
    phrase: np.ndarray
    depth: int

    def walk(self, lang: str, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, state) of all positions where a phrase is accepted; the
        states of all positions move together, one level at a time."""
        if lang not in self.roots:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # A root's edges are one span: a table from code to state.
        lo, hi = np.searchsorted(self.check, [self.roots[lang] << 32, self.roots[lang] + 1 << 32])
        first = np.full(len(self.codes) + 1, -1, dtype=np.int64)  # the last is code -1's
        first[self.check[lo:hi] & HALF] = len(self.roots) + np.arange(lo, hi)
        state = first[codes]
        at = np.flatnonzero(state >= 0)
        state = state[at]
        for d in range(1, self.depth):
            inside = at + d < len(codes)
            at, state = at[inside], state[inside]
            code = codes[at + d]
            known = code >= 0
            at, key = at[known], (state[known] << 32) | code[known]
            edges = self.check[self.starts[d]:self.starts[d + 1]]
            place = np.searchsorted(edges, key)
            place[place == len(edges)] = 0
            alive = edges[place] == key
            at, state = at[alive], len(self.roots) + self.starts[d] + place[alive]
        return at, state


def build_trie(langs: list[str] | pa.Array, phrases: list[bytes] | pa.Array) -> Trie:
    """The trie of distinct (language, phrase) pairs of one length: every level
    is one sort of its edges."""
    split = pc.split_pattern(pa.array(phrases, pa.binary()), pattern=b" ")
    words = split.flatten().dictionary_encode()
    depth = len(words) // len(split)
    codes = {w: i for i, w in enumerate(words.dictionary.to_pylist())}
    symbols = words.indices.to_numpy().astype(np.int64).reshape(-1, depth)
    own = pa.array(langs, pa.string()).dictionary_encode()
    roots = {lang: i for i, lang in enumerate(own.dictionary.to_pylist())}
    node = own.indices.to_numpy().astype(np.int64)
    levels, starts = [], [0]
    for d in range(depth):
        edges, back = np.unique((node << 32) | symbols[:, d], return_inverse=True)
        node = len(roots) + starts[-1] + back.reshape(-1)
        levels.append(edges)
        starts.append(starts[-1] + len(edges))
    by = np.argsort(node)
    return Trie(codes, roots, np.concatenate(levels), np.array(starts), node[by], by, depth)


def word_hash(word: bytes) -> int:
    """XXH64 with seed 42 as a signed integer: Spark's ``xxhash64``."""
    h = xxhash.xxh64_intdigest(word, 42)
    return h - 2**64 if h >= 2**63 else h


class Followers:
    """Counts of (state, following word) pairs of a task, as integers.  Words
    have the trie's codes; ``others``, where there are more tries than this
    one, numbers the remaining words as they come."""

    def __init__(self, trie: Trie, others: bool):
        self.known, self.others = list(trie.codes), others
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.keys, self.counts, self.pending = np.zeros(0, np.int64), np.zeros(0, np.int64), []

    def add(self, state: np.ndarray, after: np.ndarray, codes: np.ndarray, words: list[bytes]) -> None:
        """Pairs of these states and the words in the places ``after``."""
        code = codes[after]
        if self.others:
            numbers, first = self.numbers, len(self.known)
            new = np.flatnonzero(code < 0)
            code[new] = [-1 if w == BREAK else first + numbers.setdefault(w, len(numbers))
                         for w in map(words.__getitem__, after[new].tolist())]
        keep = code >= 0
        self.pending.append(np.unique((state[keep] << 32) | code[keep], return_counts=True))
        if sum(len(k) for k, _ in self.pending) > max(HELD // 4, len(self.keys)):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.pending)])
        counts = np.concatenate([self.counts, *(c for _, c in self.pending)])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        self.pending = []

    def full(self) -> bool:
        return len(self.keys) > HELD or len(self.numbers) > HELD

    def report(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(state, hash of the word, count) of all pairs."""
        self.merge()
        words = np.array([word_hash(w) for w in (*self.known, *self.numbers)], dtype=np.int64)
        return self.keys >> 32, words[self.keys & HALF], self.counts


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, phrase, f) of single words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, c in held.items():
                c.pop(BREAK, None)
                yield _phrase_rows([lang] * len(c), list(c), list(c.values()))
            held.clear()

        for lang, text in text_slices(batches):
            held.setdefault(lang, Counter()).update(words_and_breaks(text))
            if sum(map(len, held.values())) > HELD // 4:
                yield from rows()
        yield from rows()

    return (texts.mapInArrow(run, "lang string, phrase binary, f long")
            .groupBy("lang", "phrase").agg(F.sum("f").alias("f")))


def _phrase_rows(langs: list, phrases: list, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(phrases, pa.binary()), pa.array(counts, pa.int64())],
        names=["lang", "phrase", "f"])


#: A pair's key is its phrase's number above its word's hash; the key of a
#: phrase's own count is -1 less its number.
PASS = "key long, f long"


def trie_pass(texts: DataFrame, langs: pa.Array, phrases: pa.Array, count: bool, report: bool, others: bool
              ) -> tuple[DataFrame, Broadcast]:
    """Rows ``PASS`` and the broadcast (trie, phrases, langs): a task's count
    of each phrase, if ``count``, and of each pair of a phrase and the hash of
    a following word, if ``report``.  ``others`` says that following words may
    be missing in this trie."""
    shared = texts.sparkSession.sparkContext.broadcast((build_trie(langs, phrases), phrases, langs))

    def rows(key: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(f), 1 << 16):
            at = slice(lo, lo + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(key[at]), pa.array(f[at])], names=["key", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared.value[0]
        size = len(trie.roots) + len(trie.check)
        counts = np.zeros(size, dtype=np.int64)
        follow = Followers(trie, others)
        number = np.zeros(size, dtype=np.int64)
        number[trie.accepts] = trie.phrase

        def reports() -> Iterator[pa.RecordBatch]:
            state, word, f = follow.report()
            yield from rows((number[state] << 32) | (word & HALF), f)
            follow.clear()

        for lang, text in text_slices(batches):
            if lang not in trie.roots:
                continue
            words = words_and_breaks(text)
            codes = np.fromiter(map(trie.codes.get, words, repeat(-1)), dtype=np.int64, count=len(words))
            at, state = trie.walk(lang, codes)
            counts += np.bincount(state, minlength=size)
            if report:
                inside = at + trie.depth < len(words)
                follow.add(state[inside], at[inside] + trie.depth, codes, words)
                if follow.full():
                    yield from reports()
        if count:
            hit = np.flatnonzero(counts[trie.accepts])
            yield from rows(-1 - trie.phrase[hit].astype(np.int64), counts[trie.accepts[hit]])
        if report:
            yield from reports()

    return texts.mapInArrow(run, PASS), shared


def named(rows: DataFrame, shared: Broadcast) -> DataFrame:
    """``PASS`` rows with language and phrase; ``word`` is the low half
    of the following word's hash, null where the phrase itself is counted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, phrases, langs = shared.value
        for b in batches:
            key = b.column(0).to_numpy()
            which = pa.array(np.where(key < 0, -1 - key, key >> 32))
            yield pa.RecordBatch.from_arrays(
                [langs.take(which), phrases.take(which), pa.array(key & HALF, mask=key < 0), b.column(1)],
                names=["lang", "phrase", "word", "f"])

    return rows.mapInArrow(run, "lang string, phrase binary, word long, f long")


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                     min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                     trie_size: int = TRIE) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, f, words) of all frequent phrases, single words
    included; (lang, n), all word occurrences)."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.col(text_col).cast("binary").alias("text"))
    singles = saved(word_counts(texts))
    totals = saved(singles.groupBy("lang").agg(F.sum("f").alias("n")))
    level = singles.where(F.col("f") >= min_count)
    hashed = level.select(F.col("lang").alias("_l"), F.col("phrase").alias("_next"), F.xxhash64("phrase").bitwiseAND(HALF).alias("_h"))
    levels = [level.withColumn("words", F.lit(1))]
    candidates = level.select("lang", "phrase")
    for words in range(1, max_words + 1):
        n = candidates.count()
        if not n:
            break
        tries = -(-n // trie_size)
        own = candidates.withColumn("trie", F.pmod(F.xxhash64("lang", "phrase"), F.lit(tries)))
        if tries > 1:
            own = saved(own)
        passes = []
        for t in range(tries):
            part = own.where(F.col("trie") == t).select("lang", "phrase").toArrow()
            if not part.num_rows:
                continue
            part = part.combine_chunks()
            rows, shared = trie_pass(texts, part.column("lang").chunk(0), part.column("phrase").chunk(0),
                                     words > 1, words < max_words, tries > 1)
            summed = rows.groupBy("key").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)
            # Written once: the counts and the pairs are read apart.
            passes.append(saved(named(summed, shared)))
        found = reduce(DataFrame.unionByName, passes)
        if words > 1:
            level = found.where("word IS NULL").select("lang", "phrase", "f")
            levels.append(level.withColumn("words", F.lit(words)))
        if words == max_words:
            break
        longer = (found.where("word IS NOT NULL")
                  .join(hashed, (F.col("lang") == F.col("_l")) & (F.col("word") == F.col("_h")))
                  .select("lang", F.concat("phrase", F.lit(b" "), "_next").alias("phrase")))
        w = F.split(F.col("phrase").cast("string"), " ", -1)
        known = level.select(F.col("lang").alias("_l"), F.col("phrase").alias("_p"))
        for at in (1, 2):
            part = F.concat_ws(" ", F.slice(w, at, words)).cast("binary")
            longer = longer.join(known, (F.col("lang") == F.col("_l")) & (part == F.col("_p")), "left_semi")
        candidates = saved(longer)
    return saved(reduce(DataFrame.unionByName, levels)), totals


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                 min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP,
                 absorbed: int = 100, trie_size: int = TRIE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases
    by their weakest cut.  A phrase is dropped if a longer one that contains
    it has at least ``absorbed`` percent of its count."""
    frequent, totals = frequent_phrases(docs, text_col, lang_col, min_count, max_words, trie_size)
    wide = "decimal(16,0)"
    text = F.col("phrase").cast("string")
    phrases = frequent.where(F.col("words") >= 2).withColumn("w", F.split(text, " ", -1))
    join = lambda a: F.concat_ws(" ", a)
    # The longest count among the longer phrases around each phrase.
    inner = F.expr("""flatten(transform(sequence(2, words - 1), m ->
        transform(sequence(1, words - m + 1), i -> concat_ws(' ', slice(w, i, m)))))""")
    around = (phrases.where(F.col("words") > 2).select("lang", "f", F.explode(F.array_distinct(inner)).alias("p"))
              .groupBy("lang", "p").agg(F.max("f").alias("longer")).select(
                  F.col("lang").alias("_l"), F.col("p").cast("binary").alias("_p"), "longer"))
    kept = (phrases.join(around, (F.col("lang") == F.col("_l")) & (F.col("phrase") == F.col("_p")), "left")
            .where(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(absorbed) * F.col("f"))))
    cut = F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(
        k.alias("k"), join(F.slice("w", F.lit(1), k)).cast("binary").alias("head"),
        join(F.slice("w", k + 1, F.col("words") - k)).cast("binary").alias("tail")))
    known = frequent.select(F.col("lang").alias("_l"), F.col("phrase").alias("_p"), F.col("f").alias("_f"))
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), F.inline(cut))
    for part, name in (("head", "l"), ("tail", "r")):
        cuts = (cuts.join(known, (F.col("lang") == F.col("_l")) & (F.col(part) == F.col("_p")))
                .withColumn(name, F.col("_f")).drop("_l", "_p", "_f"))
    # One row per language: the number of languages bounds it, not the corpus.
    cuts = cuts.join(totals.withColumnRenamed("lang", "_l"), F.col("lang") == F.col("_l")).drop("_l")
    score = F.expr(f"(cast(1000 * cast(a as {wide}) as {wide}) * cast(n as {wide})) "
                   f"div (cast(l as {wide}) * cast(r as {wide}))")
    best = (cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
            .select("lang", F.col("phrase").cast("string").alias("phrase"), "a", "m.l", "m.r", "n", "m.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language is ranked in slices first, so that only top of each meet.
    slices = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = (best.withColumn("_s", slices)
             .withColumn("rank", F.row_number().over(W.partitionBy("lang", "_s").orderBy(*order)))
             .where(F.col("rank") <= top))
    ranked = (first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long"))
              .where(F.col("rank") <= top))
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
