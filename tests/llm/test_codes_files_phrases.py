"""Vector codes, token files and phrase tries against brute force."""

import collections
import hashlib
import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quarry.llm import phrase_tries, token_files, vector_codes
from quarry.llm.queries import QUERIES
from tests.llm import data

SF = "/root/testdata/sf0.001"


# --- vector codes -----------------------------------------------------------

def brute_codes(rows, parts=4, entries=256, rounds=4):
    """rows: (vec_id, vector), all of one length."""
    v = [[int(np.floor(float(np.float32(x)) * 1024)) for x in vec] for _, vec in rows]
    order = sorted(range(len(v)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, v[i]))
    cuts = vector_codes.cuts(len(v[0]), parts)
    books = [[v[i][a:b] for i in order[:entries]] for a, b in cuts]

    def near(part, book):
        d = [sum((x - y) ** 2 for x, y in zip(part, e, strict=True)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p, (a, b) in enumerate(cuts):
            at = [near(x[a:b], books[p])[0] for x in v]
            for e in set(at):
                mine = [x[a:b] for x, k in zip(v, at, strict=True) if k == e]
                books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for x in v:
        found = [near(x[a:b], books[p]) for p, (a, b) in enumerate(cuts)]
        out.append(("".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found), sha))
    return out


@pytest.mark.parametrize("dim,entries,n", [(8, 256, 60), (8, 5, 200), (7, 16, 120), (3, 4, 50)])
def test_vector_codes_against_brute_force(spark, dim, entries, n):
    rng = np.random.default_rng(dim * n)
    # Coarse values, so that prefixes are shared and distances tie.
    vec = (rng.integers(-3, 4, size=(n, dim)) / 4).astype("float32").tolist()
    rows = [(i // 2 if i % 7 else None, vec[i] if i % 5 else vec[0], i % 3 or None) for i in range(n)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = vector_codes.vector_codes(df.repartition(3), entries=entries).select(
        "vec_id", "label", "code", "error", "codebooks_sha256", "label_error").collect()
    want = brute_codes([r[:2] for r in rows], entries=entries)
    by_label = collections.Counter()
    for r, w in zip(rows, want, strict=True):
        by_label[r[2]] += w[1]
    expect = [(r[0], r[2], *w, by_label[r[2]]) for r, w in zip(rows, want, strict=True)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expect))


@pytest.mark.parametrize("leaves", [1, 3, 1000])
def test_trie_walk_equals_direct_distances(monkeypatch, leaves):
    monkeypatch.setattr(vector_codes, "LEAVES", leaves)
    rng = np.random.default_rng(leaves)
    for width, high, scale in ((1, 3, 1), (4, 2, 1), (5, 9, 1 << 20), (0, 2, 1)):
        points = np.unique(rng.integers(-high, high, size=(300, width)) * scale, axis=0)
        book = rng.integers(-high, high, size=(17, width)).astype(np.int64) * scale
        at, far = vector_codes.nearest_entries(points, book)
        d = ((points[:, None, :] - book[None]) ** 2).sum(axis=2)
        assert (far == d.min(axis=1)).all()
        assert (at == d.argmin(axis=1)).all()


def test_vector_codes_lengths_apart_and_large_components(spark):
    rows = [(1, [0.5] * 8, 1), (2, [0.25] * 8, None), (3, [1.0, 2.0, 3.0], 1), (4, [], 1), (5, None, 1),
            (6, [float("inf")] * 8, 1), (7, [None] * 8, 1)]
    schema = "vec_id long, embedding array<double>, label int"
    got = {r.vec_id: r for r in vector_codes.vector_codes(spark.createDataFrame(rows, schema)).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert got[1].code == "00000000" and got[2].code == "01010101" and got[3].code == "00000000"
    assert got[1].error == got[3].error == got[4].error == 0
    assert got[1].codebooks_sha256 == got[2].codebooks_sha256 != got[3].codebooks_sha256
    with pytest.raises(Exception, match="exceeds"):
        vector_codes.vector_codes(spark.createDataFrame([(1, [1e9] * 4, 1)], schema)).collect()


def test_vector_codes_same_on_any_partitioning(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    few, many = (sorted(map(tuple, vector_codes.vector_codes(df.repartition(n)).collect())) for n in (1, 7))
    assert few == many


# --- token files ------------------------------------------------------------

def library_rows(rows, end_id=1):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out, start = [], 0
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


AWKWARD = ["", None, "plain words here", "a <|endoftext|> b", "<|startoftext|>", "x<|endoftext|>y", "tab\tand\x0bmore",
           "nbsp between words", "don't we'll it's 'S", "\x1c\x1d split\x85me", "é ́e  é",
           "123 4 5,6.7", "İstanbul ΣΑΣ σς", "日本語 テスト", "😀😀 !?", " " * 50, "w" * 5000, "\n\n lines \r\n",
           "a\u0000b", "CAFÉ, Ñandú! ÀÖØßÿ... Ð÷× ab_c <|a|> a|b. ^x` {z} ~~ [q] \\ é's É'LL 'é x² ½", "'s 't 're", "ﬁ ﬀ ①"]


def test_token_files_equal_the_library(spark):
    rng = random.Random(4)
    texts = AWKWARD + ["".join(rng.choice("ab 'sé\n\t<|>.,0 ́Ω😀") for _ in range(rng.randint(1, 80)))
                       for _ in range(300)] + [data.prose(rng, 40_000)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    folder = token_files.new_folder(spark)
    token_files.write_token_files(df, public_tokenizers.path("word_bpe_49k.json"), folder, 1)
    got = sorted(map(tuple, token_files.read_token_files(spark, folder).collect()))
    assert got == library_rows(rows)


def test_token_files_on_a_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = sorted(map(tuple, QUERIES["op12_token_files"](spark, SF).collect()))
    assert got == library_rows(sorted(map(tuple, docs.collect())))


def test_token_files_layout_and_hot_ids(spark):
    rng = random.Random(6)
    rows = [(i, data.prose(rng, rng.randint(0, 30))) for i in range(200)]
    rows += [(None, "no id")] * 150 + [(None, None)] * 3 + [(7, "again"), (7, "again")]
    folder = token_files.new_folder(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    m = token_files.write_token_files(df, public_tokenizers.path("word_bpe_49k.json"), folder, 1)
    assert m == token_files.read_manifest(folder) and m["type"] == "<u2" and m["docs"] == len(rows)
    assert len(m["shards"]) > 1 and sum(s["nulls"] for s in m["shards"]) == 153
    assert max(s["docs"] for s in m["shards"]) < 150  # the hot id is not one shard
    got = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is None, i or 0))
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    whole = np.concatenate([token_files.document(folder, m, d) for d in range(m["docs"])])
    assert len(whole) == m["tokens"] and (whole == 1).sum() >= len(rows)
    shard = token_files.Shard(folder, m["shards"][0]["name"], m["type"])
    assert isinstance(shard.ids, np.memmap) and int(shard.offsets[-1]) == len(shard.ids)
    left = token_files.file_system(folder)[1]
    assert not [f for f in os.listdir(left) if f.startswith("_attempt")]


def test_token_files_of_nothing(spark):
    folder = token_files.new_folder(spark)
    empty = spark.createDataFrame([], "doc_id long, text string")
    m = token_files.write_token_files(empty, public_tokenizers.path("word_bpe_49k.json"), folder, 1)
    assert m["docs"] == 0 and token_files.read_token_files(spark, folder).count() == 0


def test_wide_ids_and_paths():
    assert token_files.id_type(65536) == "<u2" and token_files.id_type(65537) == "<u4"
    where, path = token_files.file_system("file:/tmp/x")
    assert path == "/tmp/x" and type(where).__name__ == "LocalFileSystem"


def test_other_tokenizers_get_whole_texts():
    from tokenizers import Tokenizer
    path = public_tokenizers.path
    assert token_files.drops_blanks(Tokenizer.from_file(path("word_bpe_49k.json")).to_str())
    assert not token_files.drops_blanks(Tokenizer.from_file(path("byte_bpe_50k.json")).to_str())


# --- phrases ----------------------------------------------------------------

def brute_phrases(rows, min_count, top, max_words=5):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\\x0a-\\x0d]", low):
            w = re.findall("[^\\x20\\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    f = {k: c for k, c in f.items() if c >= min_count}
    absorbed = collections.Counter()
    for (lang, p), c in f.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                key = lang, p[i:i + m]
                absorbed[key] = max(absorbed[key], c)
    out = []
    for lang in sorted(n):
        mine = []
        for (own, p), a in f.items():
            if own != lang or len(p) < 2 or absorbed[lang, p] >= a:
                continue
            s, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            mine.append((-s, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, le, r, n[lang], -s)
                for i, (s, a, p, le, r) in enumerate(sorted(mine)[:top])]
    return out


def phrase_rows(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["É", "\u0085x", "'", "日本", "a-b"]
    rows = [(rng.choice(["en", "fr", None, "und"]),
             "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n"])
                     for _ in range(rng.randint(0, 80)))) for _ in range(120)]
    rows += [("en", "Alpha beta gamma delta epsilon zeta. " * 30)] * 3 + [("en", None), (None, "")]
    return rows


@pytest.mark.parametrize("min_count,trie_size,top", [(5, 200_000, 2000), (3, 40, 50), (100, 200_000, 2000)])
def test_phrases_against_brute_force(spark, min_count, trie_size, top):
    rows = phrase_rows(min_count)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = phrase_tries.collocations(df, min_count=min_count, trie_size=trie_size, top=top).collect()
    assert sorted(map(tuple, got)) == sorted(brute_phrases(rows, min_count, top))


def test_pairs_that_tasks_report_early(monkeypatch):
    monkeypatch.setattr(phrase_tries, "HELD", 8)
    rows = phrase_rows(2)
    batches = [(lang or "und", (text or "").encode()) for lang, text in rows]
    want = collections.Counter()
    for lang, text in batches:
        ws = phrase_tries.words_and_breaks(text)
        for a, b in zip(ws, ws[1:], strict=False):
            if phrase_tries.BREAK not in (a, b) and a == b"w1":
                want[lang, a + b" " + b] += 1
    trie = phrase_tries.build_trie(["en", "fr", "und"], [b"w1"] * 3)
    hashes = {phrase_tries.word_hash(w): w for _, t in batches for w in phrase_tries.words_and_breaks(t)}
    for others in (True, False):
        follow, got = phrase_tries.Followers(trie, others), collections.Counter()

        def drain(follow, got):
            state, words, f = follow.report()
            of = dict(zip(trie.accepts.tolist(), trie.phrase.tolist(), strict=True))
            for s, h, n in zip(state.tolist(), words.tolist(), f.tolist(), strict=True):
                got[["en", "fr", "und"][of[s]], b"w1 " + hashes[h]] += n
            follow.clear()

        for lang, text in batches:
            words = phrase_tries.words_and_breaks(text)
            codes = np.array([trie.codes.get(w, -1) for w in words], dtype=np.int64)
            at, state = trie.walk(lang, codes)
            inside = at + 1 < len(words)
            follow.add(state[inside], at[inside] + 1, codes, words)
            if follow.full():
                drain(follow, got)
        drain(follow, got)
        assert got == (want if others else {k: n for k, n in want.items() if k[1] == b"w1 w1"})


def test_word_hash_is_sparks(spark):
    words = ["", "a", "été", "x" * 100]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64(F.col("w").cast("binary")))
    assert [r[0] for r in got.collect()] == [phrase_tries.word_hash(w.encode()) for w in words]


@pytest.mark.parametrize("n,vocabulary", [(1, 1), (300, 20), (3000, 700), (2000, 70_000)])
def test_trie_accepts_exactly_its_phrases(n, vocabulary):
    rng = random.Random(n)
    words = [f"w{i}".encode() for i in range(vocabulary)]
    pairs = sorted({(rng.choice(["en", "fr"]), b" ".join(rng.choice(words) for _ in range(3))) for _ in range(n)})
    langs, phrases = [p[0] for p in pairs], [p[1] for p in pairs]
    trie = phrase_tries.build_trie(langs, phrases)
    assert len(trie.check) < 16 * (9 * n + 256)
    text = b" ".join(p for p in phrases).split() + [rng.choice(words) for _ in range(500)] + [b"unknown"]
    codes = np.array([trie.codes.get(w, -1) for w in text])
    for lang in ("en", "fr", "xx"):
        at, state = trie.walk(lang, codes)
        got = {(int(a), phrases[trie.phrase[np.searchsorted(trie.accepts, s)]]) for a, s in
               zip(at, state, strict=True)}
        own = {p for o, p in pairs if o == lang}
        want = {(i, b" ".join(text[i:i + 3])) for i in range(len(text) - 2) if b" ".join(text[i:i + 3]) in own}
        assert got == want


def test_a_trie_of_many_words_has_no_more_states_than_edges():
    rng = random.Random(5)
    phrases = sorted({b"w%d w%d" % (rng.randrange(70_000), rng.randrange(70_000)) for _ in range(50_000)})
    trie = phrase_tries.build_trie(["en"] * len(phrases), phrases)
    assert len(trie.check) <= 2 * len(phrases)


def test_phrase_count_beyond_64_bits(spark):
    """1000 * a * n of 10**12 words leaves 64 bits; the decimals hold it."""
    row = spark.range(1).select(F.expr(
        "(cast(1000 * cast(3000000001 as decimal(16,0)) as decimal(16,0)) * cast(1000000000007 as decimal(16,0))) "
        "div (cast(3000000007 as decimal(16,0)) * cast(5 as decimal(16,0)))").alias("s")).first()
    assert row.s == 1000 * 3000000001 * 1000000000007 // (3000000007 * 5)
