"""The operators against brute force, exact rules and planted cases."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.llm import (
    cross_polytope,
    gam_pairs,
    language_mixture,
    license_templates,
    line_windows,
    queries,
    simhash_gray,
    systematic_mix,
    template_decontam,
    token_cache,
    toxic_segments,
)
from quarry.llm.common import labelled_sample
from tests.llm import data


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


# --- template decontamination ------------------------------------------------

ITEM = ("A train leaves the station at 40 km per hour while Anna Maria waits with 3 bags near the old "
        "bridge, and 40 people watch as the friend Boris counts to 3 before the bells ring")


def hits(spark, texts, items=(ITEM,)):
    rows = template_decontam.contaminated(
        docs_of(spark, texts), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    return {(r.doc_id, r.item_id): r for r in rows.collect()}


def test_decontamination_planted(spark):
    rng = random.Random(1)
    swapped = ITEM.replace("40", "75").replace("3", "8").replace("Anna Maria", "Olga").replace("Boris", "Ivan")
    uneven = ITEM.replace("at 40", "at 75").replace("counts to 3", "counts to 9")
    noise = [data.prose(rng, 60) for _ in range(6)]
    found = hits(spark, [noise[0] + "\n" + ITEM + "\n" + noise[1], swapped, uneven, noise[2], None, "",
                         noise[3] + " " + ITEM.upper(), ITEM[:60]])
    assert found[0, 0].kind == "verbatim" and found[0, 0].coverage >= 0.8
    assert found[1, 0].kind == "reparameterised" and found[1, 0].changed_slots == 4
    assert (2, 0) not in found  # one value of the item became two
    assert {d for d, _ in found} <= {0, 1, 6}


def test_decontamination_in_any_case_and_layout(spark):
    rng = random.Random(2)
    question = ("Tom has 3 red apples in the basket. Tom gives 2 apples to his sister. Anna then eats one of them "
                "in the garden. How many apples does Tom have left at the end of the day?")
    other = question.replace("Tom", "Boris").replace("Anna", "Olga").replace("3", "9")
    noise = [data.prose(rng, 40) for _ in range(2)]
    wrapped = ITEM.replace(" Anna", "\nAnna").replace(" Boris", "  Boris")
    texts = [t if i % 2 else noise[0] + ".\n" + t + "\n" + noise[1] for i, t in enumerate(
        [ITEM.upper(), ITEM.lower(), wrapped, ITEM.replace(" ", "\n"), other, question.upper()])]
    found = hits(spark, texts, (ITEM, question))
    assert {k: r.kind for k, r in found.items()} == {
        (0, 0): "verbatim", (1, 0): "verbatim", (2, 0): "verbatim", (3, 0): "verbatim",
        (4, 1): "reparameterised", (5, 1): "verbatim"}


def test_template_words_and_slots_align():
    text = "Pay $5 or 7 kg, says Tom Thumb to seven men in b2b at 3,000.50 m"
    words, values = template_decontam.template_words(text), template_decontam.slot_values(text)
    assert len(words) == len(values)
    assert [(w, v) for w, v in zip(words, values) if v is not None] == [
        (b"2", "$"), (b"0", "5"), (b"0", "7"), (b"2", "kg"), (b"1", "tom thumb"), (b"0", "seven"),
        (b"0", "2"), (b"0", "3,000.50"), (b"2", "m")]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB3 .,$%kgÉé\n1one", max_size=80))
def test_template_alignment_holds_for_any_text(text):
    words, values = template_decontam.template_words(text), template_decontam.slot_values(text)
    assert len(words) == len(values)
    assert all((w in (b"0", b"1", b"2")) == (v is not None) for w, v in zip(words, values))


def test_decontamination_against_brute_force(spark):
    rng = random.Random(4)
    items = [data.prose(rng, rng.randint(6, 30)) for _ in range(8)]
    texts = []
    for _ in range(40):
        t = data.prose(rng, 40)
        if rng.random() < 0.5:
            part = rng.choice(items).split()
            t += " " + " ".join(part[: rng.randint(4, len(part))]) + " " + data.prose(rng, 5)
        texts.append(t)
    want = set()
    for d, t in enumerate(texts):
        w = t.split()
        have = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        for k, item in enumerate(items):
            v = item.split()
            windows = [tuple(v[i:i + 5]) for i in range(len(v) - 4)]
            if sum(x in have for x in windows) / len(windows) >= 0.8:
                want.add((d, k))
    assert set(hits(spark, texts, items)) == want and want


# --- license templates -------------------------------------------------------

def scan(text):
    words = license_templates.words_of(text.encode())
    return license_templates.scan(words, license_templates.compiled()), license_templates.base_places(words)


def test_license_regions():
    def labels(text):
        return scan(text)[0][0]

    assert scan("x Licensed under the Apache License, Version 2.0. y") == (({"apache-2.0"}, set()), [(4, "apache")])
    assert labels("licensed under the Apache License 2.0") == {"apache-2.0"}  # optional word absent
    assert labels("licensed under an Apache License, Version 2.0") == set()  # mandatory word changed
    assert labels("Distributed under the terms of the MIT License") == {"mit"}
    assert labels("# SPDX-License-Identifier: BSD-3-Clause") == {"bsd-3-clause"}
    assert labels("spdx license identifier unknown") == set()
    assert scan("MIT License, GNU General Public License")[1] == [(0, "mit"), (3, "gpl")]
    assert scan("") == ((set(), set()), [])
    for broken in ("a <<beginOptional>> b", "a <<endOptional>>", "a <<var;other=2>>"):
        with pytest.raises(ValueError):
            license_templates.parse(broken)
    with pytest.raises(ValueError):
        license_templates.Template.of("x", "<<var;max=2>> a", True)


def filled(markup, holder="The Example Authors and Contributors", optional=True):
    """A notice's text with one holder's name and the first of its wordings."""
    if not optional:
        while "<<begin" in markup:
            markup = re.sub(r"(?s)<<beginOptional>>(?:(?!<<beginOptional>>).)*?<<endOptional>>", "", markup, count=1)
    markup = re.sub(r"<<beginOptional>>|<<endOptional>>", "", markup)
    markup = re.sub(r"<<var;max=\d+>>", holder, markup)
    return re.sub(r"(?s)<<var;match=(.*?)(?:\|.*?)?>>", r"\1", markup)


@pytest.mark.parametrize("label,markup", license_templates.NOTICES)
def test_whole_notices(label, markup):
    for text in (filled(markup), filled(markup, "Jo", optional=False), filled(markup).upper(),
                 filled(markup).replace(",", " --\n * ")):
        assert scan("Copyright 2020\n" + text + "\nend")[0][1] == {label}
    # every mandatory word changed, left out or doubled in its turn
    words = filled(markup).split()
    (single,) = [t for t in license_templates.compiled() if t.whole and t.label == label]
    for at in range(0, len(words), 7):
        for other in ([], ["cow"], ["you", "must", "send", "a", "cow", words[at]]):
            changed = " ".join(words[:at] + other + words[at + 1:])
            got = label in scan(changed)[0][1]
            assert got == bool(re.search(" " + queries._license_regex(markup), " " + " ".join(
                w.decode() for w in license_templates.words_of(changed.encode())) + " "))
    assert not single.automaton.accepts(license_templates.words_of(" ".join(words[:-1]).encode()), 0)


def test_altered_conditions_are_refused():
    bsd = dict(license_templates.NOTICES)["bsd-3-clause"]
    text = filled(bsd)
    assert scan(text)[0] == ({"bsd-3-clause"}, {"bsd-3-clause"})
    opening = text[:text.index("Redistributions of source")]
    assert scan(opening + "you must send the author a cow")[0] == (set(), set())
    assert scan(text.replace("must reproduce", "need not reproduce"))[0] == (set(), set())
    assert scan(text.replace("The Example Authors", "x " * 30))[0] == (set(), set())  # no name of 30 words


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("a b c d".split()), max_size=9))
def test_automaton_equals_regular_expression(words):
    markup = ("a <<beginOptional>> b <<beginOptional>> c <<endOptional>> <<endOptional>> <<var;max=2>> "
              "<<var;match=c|d d>>")
    m = license_templates.Automaton.of(license_templates.parse(markup))
    pattern = re.compile(r"a (?:b (?:c )?)?(?:\S+ ){1,2}(?:c |d d )")
    got = any(m.accepts([w.encode() for w in words], i) for i in range(len(words)))
    assert got == any(pattern.match(" ".join(words[i:]) + " ") for i in range(len(words)))


# --- language mixture --------------------------------------------------------

def test_language_mixture(spark):
    rng = random.Random(2)
    vocab = {"en": "the and of with this that from hands".split(), "fr": "le les des être où après".split(),
             "de": "der über nicht auch schön groß".split()}
    rows = [(i, data.prose(rng, 40, vocab[x]), x) for i, x in enumerate(["en", "fr", "de"] * 20)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    from pyspark.sql import functions as F
    model = language_mixture.fit(train, F.lit(True))
    assert model.langs == ["de", "en", "fr"]
    both = data.prose(rng, 60, vocab["en"]) + " " + data.prose(rng, 20, vocab["fr"])
    test = docs_of(spark, [data.prose(rng, 30, vocab["fr"]), both, None, "12 %%", "der"])
    got = {r.doc_id: r for r in language_mixture.predict(test, model, {"doc_id": F.col("doc_id")}).collect()}
    assert got[0].lang_pred == "fr" and got[0].langs == "fr" and got[0].score == 1.0
    assert got[1].lang_pred == "en" and got[1].langs == "en,fr" and 0.6 < got[1].score < 0.9
    assert [(got[i].lang_pred, got[i].score) for i in (2, 3)] == [("und", 0.0)] * 2
    assert got[4].lang_pred == "de"


def test_em_never_lowers_likelihood():
    rng = np.random.default_rng(0)
    p = rng.dirichlet(np.ones(50), size=3).T
    counts = rng.integers(1, 9, size=50)
    pi, fit = language_mixture.proportions(p, counts, np.full(3, 1 / 3))
    assert abs(pi.sum() - 1) < 1e-9
    assert fit >= counts @ np.log(p @ np.full(3, 1 / 3)) - 1e-9


# --- cross-polytope ----------------------------------------------------------

def test_hadamard_is_orthogonal():
    x = np.random.default_rng(1).normal(size=(16, 5))
    assert np.allclose(cross_polytope.hadamard(cross_polytope.hadamard(x)), x)


def test_probes_are_the_best_buckets():
    h = cross_polytope.Hashes(6, 100, tables=1)
    x = np.random.default_rng(1).normal(size=(4, 6))
    a = [h.axes(x, 0, lv) for lv in range(len(h.radix))]
    loss = np.zeros((4, 1))
    for v in a:
        loss = (loss[:, :, None] + (v.max(axis=1, keepdims=True) - v)[:, None, :]).reshape(4, -1)
    for i in range(4):
        assert set(h.probes(x, 0, 7)[i]) == set(np.argsort(loss[i], kind="stable")[:7])
    assert (h.bucket(x, 0) == loss.argmin(axis=1)).all()


def brute(ids, x, k=20):
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        s = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -s)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in order]
    return out


@pytest.mark.parametrize("n,scaled", [(60, False), (2500, False), (2500, True)])
def test_nearest_against_brute_force(spark, n, scaled):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 32)).astype("float32").astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = (x * (rng.uniform(0.5, 2, size=(n, 1)) if scaled else 1)).astype("float32").astype(float)
    x[n // 2: n // 2 + 30] = x[0]  # a group of copies: ties to smaller ids
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in cross_polytope.nearest(df, lambda i: i % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute(np.arange(n), x)
    assert set(got) == set(want)
    found = 0
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1)) and len(rows) == min(20, n - 1)
        assert all(abs(s - float(x[q] @ x[v])) < 1e-12 for _, v, s in rows)
        found += len({v for _, v, _ in rows} & {v for v, _ in want[q]})
    assert found / sum(map(len, want.values())) >= (1.0 if n == 60 else 0.9)


@pytest.mark.parametrize("kind", ["lognormal", "outlier"])
def test_nearest_with_unequal_lengths(spark, kind):
    rng = np.random.default_rng(8)
    n = 2500
    x = rng.normal(size=(n, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "lognormal":
        x *= np.exp(rng.normal(size=(n, 1)) * 0.5)
    else:
        x[1] *= 100
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in cross_polytope.nearest(df, lambda i: i % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute(np.arange(n), x)
    found = sum(len(got.get(q, set()) & {v for v, _ in rows}) for q, rows in want.items())
    assert found / sum(map(len, want.values())) >= 0.9


def test_nearest_completes_queries_whose_probes_find_little(spark):
    rng = np.random.default_rng(9)
    n = 2500
    x = rng.normal(size=32) + 1e-3 * rng.normal(size=(n, 32))  # one tight cluster
    x[:400:20] = rng.normal(size=(20, 32))  # 20 queries far from it
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[1] *= 100
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in cross_polytope.nearest(df, lambda i: i % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert {q: len(v) for q, v in got.items()} == {q: 20 for q in range(0, n, 20)}


# --- quality model -----------------------------------------------------------

def test_gam_learns_single_and_pair_effects():
    rng = np.random.default_rng(3)
    x = rng.uniform(size=(4000, len(gam_pairs.FEATURES)))
    y = (((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)) | (x[:, 2] > 0.9)).astype(float)
    m = gam_pairs.fit_tables(x[:3000], y[:3000])
    assert (0, 1) in m.pairs
    assert ((m.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.93


def test_gam_degenerate_labels():
    x = np.zeros((3, len(gam_pairs.FEATURES)))
    assert gam_pairs.fit_tables(x, np.ones(3)).score(x)[0] > 0.99
    assert gam_pairs.fit_tables(x[:0], np.zeros(0)).score(x)[0] == 0.5
    assert gam_pairs.features(None) == gam_pairs.features(b"") == [0.0] * len(gam_pairs.FEATURES)


# --- SimHash -----------------------------------------------------------------

def plain_fingerprint(text, n=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    sh = [" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aBÉ \t\n\x0b\x1c c", max_size=60))
def test_fingerprint_rule(text):
    assert simhash_gray.fingerprint(text.encode()) == plain_fingerprint(text)


def test_gray_rank_orders_neighbours():
    codes = np.array([i ^ (i >> 1) for i in range(300)], dtype=np.uint64)
    assert (simhash_gray.gray_rank(codes) == np.arange(300)).all()


@pytest.mark.parametrize("n", [1, 2, 16, 17, 700])
def test_gray_index_finds_exactly_the_near_ones(n):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 2**63, size=max(1, n // 5), dtype=np.uint64)
    fps = base[rng.integers(0, len(base), n)]
    for _ in range(4):
        fps = fps ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    got = {(int(a), int(b)) for q, m in simhash_gray.GrayIndex(fps).search(fps, 4) for a, b in zip(q, m)}
    d = np.bitwise_count(fps[:, None] ^ fps[None, :])
    assert got == {(int(a), int(b)) for a, b in zip(*np.nonzero(d <= 4))}


def plain_groups(ids, fps, k=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= k:
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        low[find(i)] = min(low.get(find(i), d), d)
    return {d: low[find(i)] for i, d in enumerate(ids)}


def test_groups_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash_gray, "BLOCK", 16)  # so that hot groups are cut into blocks
    rng = random.Random(8)
    texts = []
    for _ in range(12):
        base = data.prose(rng, 60).split()
        for _ in range(rng.randint(1, 12)):
            w = list(base)
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = rng.choice(data.WORDS)
            texts.append(" ".join(w))
    texts += ["", None, "  ", "same four words here", "same four words here"]
    rng.shuffle(texts)
    got = {r.doc_id: r for r in simhash_gray.simhash_groups(docs_of(spark, texts)).collect()}
    fps = [plain_fingerprint(t) for t in texts]
    assert all(got[i].fp % 2**64 == f for i, f in enumerate(fps))
    want = plain_groups(list(range(len(texts))), fps)
    assert {i: r.component_id for i, r in got.items()} == want
    kept = simhash_gray.keep_one_per_group(docs_of(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = dict(map(tuple, simhash_gray.components(
        spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 50)}


# --- token cache -------------------------------------------------------------

def test_counts_equal_the_library(spark, tmp_path):
    from tokenizers import Tokenizer
    path = "/opt/tokenizers/byte_bpe_50k.json"
    plain = Tokenizer.from_file(path)
    rng = random.Random(6)
    bits = ["don't", "I'll", " ", "  ", "\n", "\n\n", "\t", "\r", "\x1c", "\x85", " ", "　", "été", "42",
            "%%%", "<|endoftext|>", "<|", "word", "_x", "日本", "🙂", "'s", "a'b"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(400)]
    texts += [" ".join(rng.choice(bits[7:]) for _ in range(8)) for _ in range(200)] + [None, "", "a b", "a b"]
    df = docs_of(spark, texts)
    got = {r.doc_id: (r.n_bytes, r.n_tokens)
           for r in token_cache.count_tokens(df, path, str(tmp_path / "cache")).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        assert got[i] == (len(t.encode()), len(plain.encode(t, add_special_tokens=False).ids)), repr(t)


def test_only_distinct_misses_are_encoded(spark, tmp_path, monkeypatch):
    cache, path = str(tmp_path / "cache"), "/opt/tokenizers/byte_bpe_50k.json"
    token_cache.count_tokens(docs_of(spark, ["a", "b", "a"]), path, cache).collect()
    assert spark.read.parquet(cache).count() == 2
    encoded = []
    real = token_cache.encode_counts
    monkeypatch.setattr(token_cache, "encode_counts",
                        lambda t, *a: encoded.extend(r.text for r in t.collect()) or real(t, *a))
    rows = token_cache.count_tokens(docs_of(spark, ["c", "a", "c", "b"]), path, cache).collect()
    assert encoded == ["c"] and len(rows) == 4 and spark.read.parquet(cache).count() == 3
    # Another tokenizer version shares nothing.
    other = "/opt/tokenizers/piece_bpe_32k.model"
    token_cache.count_tokens(docs_of(spark, ["a"]), other, cache).collect()
    assert spark.read.parquet(cache).count() == 4


# --- toxic segments ----------------------------------------------------------

def plain_segments(w):
    """The defining recursion: the best segment, then both sides of it."""
    best, place = 0.0, None
    for i in range(len(w)):
        for j in range(i + 1, len(w) + 1):
            s = sum(w[i:j])
            if s > best + 1e-9:
                best, place = s, (i, j)
    if place is None:
        return []
    i, j = place
    left, right = plain_segments(w[:i]), plain_segments(w[j:])
    return left + [(i, j)] + [(a + j, b + j) for a, b in right]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-40, 30).map(lambda v: v + 0.5 if v % 2 else v - 0.25), max_size=14))
def test_segments_are_all_maximal_ones(weights):
    got = toxic_segments.segments(np.array(weights, dtype=float))
    assert sum(s for _, _, s in got) == pytest.approx(sum(sum(weights[a:b]) for a, b in plain_segments(weights)))
    assert all(s > 0 and s == pytest.approx(sum(weights[a:b])) for a, b, s in got)
    assert all(x[1] <= y[0] for x, y in zip(got, got[1:]))


def test_planted_toxic_words(spark):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(400):
        words = data.prose(rng, 60).split()
        toxic = i % 5 == 1
        if toxic:
            words.insert(rng.randrange(60), rng.choice(data.TOXIC))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxic_segments.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    from pyspark.sql import functions as F
    got = toxic_segments.score_texts(docs, model, {"doc_id": F.col("doc_id")}).collect()
    for r in got:
        assert (r.score >= 0.5) == bool(labels[r.doc_id][1])
        if r.score >= 0.5:
            words = rows[r.doc_id][1].split()
            assert set(words[r.first_word:r.last_word + 1]) & set(data.TOXIC)
    kept = toxic_segments.reject_toxic(docs, model).collect()
    assert sorted(r.doc_id for r in kept) == [i for i, y in labels if not y]


# --- systematic mix ----------------------------------------------------------

def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > cap * sizes[s] + 1e-9}
        if not over:
            return out | {s: left * w[s] / total for s in open_}
        for s in over:
            out[s] = float(cap * sizes[s])
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def test_targets_and_copies(spark):
    rng = random.Random(3)
    sizes = {"a": 5, "b": 300, "c": 4000, "d": 10, "é": 900, "z": 2500, None: 60}
    rows, i = [], 0
    for s, docs in sizes.items():
        for _ in range(docs // 5 or 1):
            rows.append((i, data.prose(rng, rng.randint(0, 30)), s))
            i += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = systematic_mix.mix_counts(df).collect()
    assert len(got) == len(rows)
    words = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in sizes}
    want = plain_targets(words)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert all(r.source_size == words[s] and r.target == pytest.approx(want[s]) for r in mine)
        assert abs(sum(r.taken for r in mine) - want[s]) <= 31  # about one document
        rate = want[s] / words[s] if words[s] else 0
        assert all(int(rate) <= r.copies <= int(rate) + 1 and r.copies <= 3 for r in mine)
    again = systematic_mix.mix_counts(df.repartition(7)).collect()
    assert sorted((r.doc_id, r.copies) for r in got) == sorted((r.doc_id, r.copies) for r in again)
    mixed = systematic_mix.mix_documents(df).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in mixed} == {r.doc_id: r.copies for r in got if r.copies}


def test_mix_many_sources(spark):
    """More sources than one task should order: targets as by resharing."""
    n = 100_000
    df = spark.range(n).selectExpr("id doc_id", "repeat('w ', cast(id % 7 as int)) text",
                                   "concat('host', id % 50021) source")
    got = systematic_mix.mix_counts(df).select("source", "source_size", "target").distinct().collect()
    sizes = {}
    for i in range(n):
        sizes[f"host{i % 50021}"] = sizes.get(f"host{i % 50021}", 0) + i % 7
    want = plain_targets(sizes)
    assert len(got) == 50021
    assert all(r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) for r in got)


def test_mix_hot_null_ids_and_equal_rows(spark):
    """A third of the rows without an id, another third equal in every column,
    and rows that differ in a further column only: each is drawn by its rank,
    and rows come back with their own columns."""
    rng = random.Random(9)
    rows = ([(None, data.prose(rng, 4), "s", k) for k in range(200)] + [(7, "one two three", "s", 0)] * 200
            + [(8, "four five six", "t", k) for k in range(40)] + [(k, data.prose(rng, 9), "t", 0) for k in range(9, 99)])
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copy long").withColumnRenamed("copy", "_n")
    counts = systematic_mix.mix_counts(df).collect()
    assert len(counts) == len(rows)
    got = systematic_mix.mix_documents(df).collect()
    by = {}
    for r in counts:
        by[(r.doc_id, r.source)] = by.get((r.doc_id, r.source), 0) + r.copies
    mixed = {}
    for r in got:
        assert (r.doc_id, r.text, r.source, r["_n"]) in rows
        mixed[(r.doc_id, r.source)] = mixed.get((r.doc_id, r.source), 0) + 1
    assert mixed == {k: v for k, v in by.items() if v}
    drawn = {}
    for r in got:
        if r.doc_id is None or r.doc_id == 8:
            drawn[(r.doc_id, r["_n"])] = drawn.get((r.doc_id, r["_n"]), 0) + 1
    rates = {r.source: r.target / r.source_size for r in counts}
    for (i, k), c in drawn.items():
        assert c <= math.ceil(rates["s" if i is None else "t"])
    assert sorted((r.doc_id or 0, r.text, r.copy) for r in got) == sorted(
        (r.doc_id or 0, r.text, r.copy) for r in systematic_mix.mix_documents(df.repartition(5)).collect())


def test_mix_is_native(spark):
    from tests.conftest import plan_text
    df = docs_of(spark, ["a b", "c"]).selectExpr("*", "'s' source")
    plan = plan_text(systematic_mix.mix_documents(df))
    assert not re.search("EvalPython|MapIn|FlatMapGroups|ArrowEval", plan)


# --- line windows ------------------------------------------------------------

def plain_dedup(texts):
    seen, out = set(), []
    for t in texts:
        if t is None:
            out.append(None)
            continue
        lines_ = t.split("\n")
        full = [(x.strip("\t\x0b\x0c\r "), i) for i, x in enumerate(lines_)]
        full = [(x, i) for x, i in full if x]
        span, gone = min(3, len(full)), set()
        for k in range(len(full) - span + 1 if span else 0):
            key = (span, *(x for x, _ in full[k:k + span]))
            if key in seen:
                gone |= set(range(full[k][1], full[k + span - 1][1] + 1))
            seen.add(key)
        out.append("\n".join(x for i, x in enumerate(lines_) if i not in gone))
    return out


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(7)
    pool = [data.prose(rng, 4) for _ in range(9)] + ["", "  "]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14))) for _ in range(80)]
    texts += [None, "", "one", "one", " one ", "a\nb", "a\nb", "x\nx\nx\nx\nx"]
    got = {r.doc_id: r.text for r in line_windows.dedup_lines(docs_of(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == plain_dedup(texts)


def test_every_removed_line_stays_somewhere(spark):
    rng = random.Random(17)
    pool = [data.prose(rng, 3) for _ in range(6)]
    texts = ["\n".join(rng.choice(pool) for _ in range(10)) for _ in range(30)]
    kept = line_windows.dedup_lines(docs_of(spark, texts)).collect()
    assert {x for t in texts for x in t.split("\n")} <= {x for r in kept for x in r.text.split("\n")}


def test_window_hash_is_md5_of_the_lines():
    assert line_windows.line_windows("a\n\n b \nc") == [
        (hashlib.md5(b"3\na\nb\nc").digest(), 0, 3)]


# --- occurrences of benchmark items ------------------------------------------

TWICE = ("Tom walks along the quiet river with his old dog and counts the boats that pass by the mill before "
         "the evening comes when Tom returns home slowly over the wooden bridge and sits down to read his book again")


def test_slots_agree_over_the_whole_occurrence(spark):
    rng = random.Random(31)
    half = TWICE.replace("Tom", "Bob", 1).replace("Tom", "Carl")
    mixed = half.replace("the mill before", "the mill some hours long before")
    w = TWICE.split()
    far = " ".join(w[:21]) + " " + data.prose(rng, 3000) + " " + " ".join(w[21:])
    inserted = TWICE.replace("Tom", "Bob").replace("the mill before", "the mill some hours long before")
    titled = TWICE.replace("Tom", "Mr. O'Neil")
    double = TWICE.replace("Tom", "Anna Maria")
    two = TWICE.replace("Tom", "Bob") + ". " + TWICE.replace("Tom", "Carl")
    texts = [mixed, far, inserted, titled, double, two, half, TWICE + " " + data.prose(rng, 9)]
    found = hits(spark, texts, (TWICE,))
    assert {d: (r.kind, r.changed_slots) for (d, _), r in found.items()} == {
        2: ("reparameterised", 1), 3: ("reparameterised", 1), 4: ("reparameterised", 1),
        5: ("reparameterised", 1), 7: ("verbatim", 0),
        6: ("verbatim", 0)}  # its slots differ, but 31 of its 37 word windows are the item's


@settings(max_examples=200, deadline=None)
@given(st.sampled_from([*template_decontam.COMMON, *template_decontam.UNITS, "mr", "tom", "x", "abc"]),
       st.sampled_from([str, str.title, str.upper, str.capitalize, str.swapcase]))
def test_ascii_words_have_the_kind_of_their_pieces(word, case):
    word = case(word)
    words = template_decontam.Words()
    n = words[word.encode()]
    _, first, count, kind, _ = words.arrays()
    assert count[n] == 1
    assert (kind[first[n]], words.piece_text[first[n]]) == template_decontam.pieces_of(word)[0]


def test_short_items_are_matched_whole(spark):
    rng = random.Random(32)
    items = ("What is 345 + 678?", "two words", "Paris", None, "...", "one two three four five")
    noise = data.prose(rng, 30)
    texts = [f"{noise} What is 345 + 678? {noise}", f"{noise} what is 346 + 678 {noise}", f"{noise}. Two words! {noise}",
             f"{noise} two words {noise}", "see Paris today", "Paris", "Where?\nParis\nyes", "One two three four five."]
    found = hits(spark, texts, items)
    assert {k: r.kind for k, r in found.items()} == {
        (0, 0): "verbatim", (2, 1): "verbatim", (5, 2): "verbatim", (6, 2): "verbatim", (7, 5): "verbatim"}


def brute_hits(texts, items):
    """Every pair, by all alignments of item and text: at each place of the
    document the longest run of one diagonal that keeps the slots consistent."""
    out = set()
    for d, t in enumerate(texts):
        for k, item in enumerate(items):
            for plain in (True, False):
                if plain:
                    clean = lambda x: re.sub("[^a-z0-9]+", " ", x.lower()).split()
                    w, v = clean(t), clean(item)
                    wv = vv = None
                else:
                    w, v = template_decontam.template_words(t), template_decontam.template_words(item)
                    wv, vv = template_decontam.slot_values(t), template_decontam.slot_values(item)
                ok = [i for i in range(len(v) - 4) if plain or sum(x is not None for x in vv[i:i + 5]) <= 2]
                for shift in range(-len(v), len(w)):
                    hit = [i for i in ok if 0 <= i + shift <= len(w) - 5 and w[i + shift:i + shift + 5] == v[i:i + 5]]
                    slots = {}
                    for i in hit:
                        for j in range(i, i + 5):
                            if not plain and vv[j] is not None:
                                slots.setdefault((v[j], vv[j]), set()).add(wv[j + shift])
                    if ok and len(hit) >= 0.8 * len(ok) and all(len(x) == 1 for x in slots.values()):
                        out.add((d, k))
    return out


def test_items_with_names_and_numbers_against_brute_force(spark):
    rng = random.Random(33)
    names, other = ["Tom", "Anna Maria", "Boris", "Eva"], ["Zoe", "Karl Otto", "Ulla", "Ben"]

    def item():
        w = data.prose(rng, rng.randint(10, 30)).split()
        for _ in range(rng.randint(1, 5)):
            w.insert(rng.randrange(1, len(w)), rng.choice([*names, "12", "7 kg", "$5"]))
        return " ".join(w)

    items = [item() for _ in range(10)]
    texts = []
    for i in range(60):
        text = data.prose(rng, 25)
        for _ in range(rng.choice([0, 1, 1, 2])):
            part = rng.choice(items)
            if rng.random() < 0.6:
                for a, b in zip(names, other):
                    part = part.replace(a, b)
                part = part.replace("12", "90")
            if rng.random() < 0.3:
                w = part.split()
                w[rng.randrange(len(w))] = "Xaver"
                part = " ".join(w)
            text += f" {part} {data.prose(rng, 6)}"
        texts.append(text)
    assert set(hits(spark, texts, items)) == brute_hits(texts, items)


# --- no caps -------------------------------------------------------------------

def test_vectors_of_every_length_are_answered(spark):
    rng = np.random.default_rng(12)
    rows = [(i, rng.normal(size=(8, 5, 5, 2)[i % 4]).tolist()) for i in range(1, 1301)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in cross_polytope.nearest(df, lambda i: i % 20 == 0, k=5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    by = dict(rows)
    queries = [i for i in by if i % 20 == 0]
    assert sorted(got) == sorted(queries)
    hit = total = 0
    for q in queries:
        own = sorted(((-float(np.dot(by[q], v)), i) for i, v in rows if i != q and len(v) == len(by[q])))[:5]
        found = [i for _, i, _ in sorted(got[q])]
        assert len(found) == 5 and all(len(by[i]) == len(by[q]) for i in found)
        hit += len(set(found) & {i for _, i in own})
        total += 5
    assert hit >= 0.9 * total


def test_more_languages_than_two_hundred_and_fifty_six(spark):
    rng = random.Random(14)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = [["".join(rng.choice(letters) for _ in range(5)) for _ in range(6)] for _ in range(300)]
    rows = [(2 * i + k, " ".join(rng.choice(own[i]) for _ in range(40)), f"l{i:03d}") for i in range(300) for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_mixture.fit(docs, docs["doc_id"] % 2 == 0)
    assert len(model.langs) == 300
    out = language_mixture.predict(docs, model, {"doc_id": docs["doc_id"]}).collect()
    lang = {r[0]: r[2] for r in rows}
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) >= 0.99 * len(out)


def test_sparse_language_model_equals_the_dense_table(spark):
    docs = spark.createDataFrame([(0, "abc abd", "x"), (1, "zzz abc", "y"), (2, "", "z")],
                                 "doc_id long, text string, lang string")
    model = language_mixture.fit(docs, docs["doc_id"] >= 0)
    dense = np.full((language_mixture.BUCKETS, len(model.langs)), language_mixture.SMOOTH)
    for text, lang in (("abc abd", "x"), ("zzz abc", "y"), ("", "z")):
        if lang in model.langs:
            at, n = language_mixture.trigram_counts(text)
            dense[at, model.langs.index(lang)] += n
    want = np.log(dense / dense.sum(axis=0, keepdims=True))
    assert np.allclose(model.log_p(np.arange(language_mixture.BUCKETS)), want, rtol=1e-12)


def test_more_evidence_always_scores_higher(spark):
    model = toxic_segments.Model(np.zeros(0, np.int64), np.zeros(0), 1.0, 1.0, -3.0, 2.0)
    e = [0.0, 1.0, 6.0, 7.0, 20.0, 100.0, 300.0]
    rows = spark.createDataFrame([(x,) for x in e], "e double")
    rows = rows.select(toxic_segments.probability(model, rows["e"]))
    got = [r[0] for r in rows.collect()]
    assert all(a < b for a, b in zip(got, got[1:]))



@pytest.mark.parametrize("max_rows", [1, 7, 50, 400, 5000])
@pytest.mark.parametrize("hot", [3, 11])
def test_labelled_sample_is_the_smallest_hashes(spark, max_rows, hot):
    """The rows of a sort of all labels, with one id in a third of them."""
    rows = [(i, i % 2) for i in range(1200)] + [(hot, 1)] * 600 + [(None, 1)] * 9 + [(5, None), (6, 7)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int").repartition(7)
    got = labelled_sample(labels, "doc_id", "toxic", 5, 0, max_rows)
    whole = (labels.where("doc_id IS NOT NULL AND toxic IN (0, 1) AND crc32(string(doc_id)) % 5 != 0")
             .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(max_rows))
    assert got.columns == ["_id", "_y"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))
    assert labelled_sample(labels.limit(0), "doc_id", "toxic", 5, 0, max_rows).count() == 0
