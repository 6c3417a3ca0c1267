"""Queries without SQL against plain-Python versions of the whole query."""

import itertools
import math
import random
import zlib

from quarry.llm import toxic_segments as toxic
from quarry.llm.queries import QUERIES
from tests.llm import data

WORDS = {"en": "the wood stream bridge light corner winter paper window garden".split(),
         "fr": "les bois ruisseau pont lumiere hiver fenetre jardin soleil roue".split(),
         "de": "der wald bruecke licht ecke fenster garten sonne rad stuhl".split()}


def trigrams(text):
    """{trigram: count} of the lower-cased ASCII words."""
    s = " " + " ".join("".join(c if "a" <= c <= "z" else " " for c in text.lower()).split()) + " "
    out = {}
    for i in range(len(s) - 2):
        out[s[i:i + 3]] = out.get(s[i:i + 3], 0) + 1
    return out


def plain_mixture(counts, p, langs, penalty=2.0):
    """Proportions of the best of all sets of languages by penalised
    likelihood, each fitted by 80 rounds of expectation-maximisation."""
    total, best = sum(counts.values()), None
    for size in range(1, len(langs) + 1):
        for chosen in itertools.combinations(langs, size):
            pi = {x: 1 / size for x in chosen}
            for _ in range(80):
                new = dict.fromkeys(chosen, 0.0)
                for t, n in counts.items():
                    mix = sum(pi[x] * p(x, t) for x in chosen)
                    for x in chosen:
                        new[x] += n * pi[x] * p(x, t) / mix / total
                pi = new
            fit = sum(n * math.log(sum(pi[x] * p(x, t) for x in chosen)) for t, n in counts.items())
            value = fit - penalty * math.log(total) * (size - 1)
            if best is None or value > best[0]:
                best = (value, pi)
    return best[1]


def test_language_query_equals_plain_mixture(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for i in range(90):
        lang = rng.choice(sorted(WORDS))
        text = data.prose(rng, rng.randint(12, 50), WORDS[lang])
        if i % 5 == 0:  # a smaller part in another language
            other = rng.choice([x for x in sorted(WORDS) if x != lang])
            text += ". " + data.prose(rng, len(text.split()) // 2, WORDS[other])
        rows.append((i, text, None if i % 11 == 0 else lang, "s"))
    rows += [(90, None, "en", "s"), (91, "12 34", "fr", "s"), (92, "WALD, LICHT; Ecke! der Stuhl", None, "s")]
    folder = data.write(tmp_path / "t", data.documents(rows, ()))
    got = {r.doc_id: r for r in QUERIES["op3_language_mixture"](spark, folder).collect()}
    assert len(got) == len(rows)

    held = {r[0]: zlib.crc32(str(r[0]).encode()) % 3 == 1 for r in rows}
    seen = {}
    for i, text, lang, _ in rows:
        if not held[i] and lang is not None and text is not None:
            for t, n in trigrams(text).items():
                seen.setdefault(lang, {})[t] = seen.setdefault(lang, {}).get(t, 0) + n
    totals = {x: sum(c.values()) + 0.1 * 2**15 for x, c in seen.items()}

    def p(lang, t):
        return (seen[lang].get(t, 0) + 0.1) / totals[lang]

    mixed = 0
    for i, text, _, _ in rows:
        assert got[i].held_out == held[i]
        if i in (90, 91):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        want = plain_mixture(trigrams(text), p, sorted(seen))
        top = max(want, key=want.get)
        assert (got[i].lang_pred, got[i].langs) == (top, ",".join(sorted(want)))
        assert abs(got[i].score - want[top]) < 0.02
        mixed += len(want) > 1
    assert mixed >= 12


def plain_segments(w, lo, hi):
    """The definition: the best contiguous sum first (shortest, leftmost), then
    the same on either side of it."""
    best = max(((sum(w[a:b]), -(b - a), -a) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    a = -best[2]
    b = a - best[1]
    return plain_segments(w, lo, a) + [best[0]] + plain_segments(w, b, hi)


def plain_logistic(x, y, ridge=1e-3):
    """Intercept and slope by 4000 steps of halving search along each axis."""
    def loss(a, b):
        out = ridge / 2 * (a * a + b * b)
        for u, v in zip(x, y, strict=True):
            z = a + b * u
            out += max(z, 0) + math.log1p(math.exp(-abs(z))) - v * z
        return out

    at, step = [0.0, 0.0], 4.0
    best = loss(*at)
    while step > 1e-6:
        moved = False
        for da, db in itertools.product((-step, 0, step), repeat=2):
            value = loss(at[0] + da, at[1] + db)
            if value < best:
                best, at, moved = value, [at[0] + da, at[1] + db], True
                break
        if not moved:
            step /= 2
    return at


def test_toxicity_query_equals_plain_segments(spark, tmp_path):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(160):
        bad = rng.random() < 0.3
        words = data.prose(rng, rng.randint(5, 25)).split()
        if bad or rng.random() < 0.05:  # a few labels disagree with the text
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randint(0, len(words)), rng.choice(data.TOXIC))
        rows.append((i, " ".join(words), "en", "s"))
        if i % 8:
            labels.append((i, 1, int(bad if rng.random() > 0.03 else not bad)))
    rows.append((160, None, None, None))
    folder = data.write(tmp_path / "t", data.documents(rows, ()), labels)
    got = {r.doc_id: r for r in QUERIES["op8_toxic_segments"](spark, folder).collect()}

    held = {r[0]: zlib.crc32(str(r[0]).encode()) % 5 == 0 for r in rows}
    texts = {r[0]: (r[1] or "").split() for r in rows}
    train = {i: y for i, _, y in labels if not held[i]}
    size = {y: sum(v == y for v in train.values()) for y in (0, 1)}
    vocabulary = {w for i in train for w in texts[i]}
    seen = {w: [sum(w in texts[i] for i in train if train[i] == y) for y in (0, 1)] for w in vocabulary}
    total, weight = 2 * toxic.PRIOR_FLAT + toxic.PRIOR_SHARE, {}
    for w, (clean, bad) in seen.items():
        prior = toxic.PRIOR_FLAT + toxic.PRIOR_SHARE * (clean + bad) / len(train)
        yes = (clean + prior, bad + prior)
        ratio = (math.log(yes[1] / (size[1] + total - yes[1])) - math.log(yes[0] / (size[0] + total - yes[0])))
        weight[w] = ratio if abs(ratio) > toxic.Z * math.sqrt(1 / yes[0] + 1 / yes[1]) else 0.0
    steps = {}
    for w, v in weight.items():
        k = math.copysign(math.floor(abs(v) / toxic.STEP + 0.5), v)
        steps[k] = steps.get(k, 0) + sum(texts[i].count(w) for i in train if train[i] == 0)
    mass = sum(n + 0.5 for n in steps.values())
    share = {k * toxic.STEP - toxic.DRIFT: (n + 0.5) / mass for k, n in steps.items()}
    low, high = 1e-9, 64.0
    for _ in range(100):
        mid = (low + high) / 2
        over = sum(f * math.exp(min(mid * x, 700)) for x, f in share.items()) > 1
        low, high = (low, mid) if over else (mid, high)
    const = sum(f * math.exp(high * x) for x, f in share.items() if x > 0)

    def evidence(words):
        scores = plain_segments([weight.get(w, 0.0) - toxic.DRIFT for w in words], 0, len(words))
        return -sum(math.log10(max(-math.expm1(-const * len(words) * math.exp(-high * s)), 1e-300)) for s in scores)

    a, b = plain_logistic([round(math.log1p(evidence(texts[i])), toxic.DIGITS) for i in train], list(train.values()))
    for i, words in texts.items():
        want = 1 / (1 + math.exp(-(a + max(b, 0.0) * math.log1p(evidence(words)))))
        assert got[i].held_out == held[i] and abs(got[i].score - want) < 2e-3, (i, got[i].score, want)
        assert got[i].predicted == int(got[i].score >= 0.5)
    assert len({round(r.score, 3) for r in got.values()}) > 5
