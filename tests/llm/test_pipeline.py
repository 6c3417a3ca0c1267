"""The whole pipeline against a plain-Python version of its five stages."""

import hashlib
import math
import random

import corpus_pipeline
from tests.llm import data
from tests.llm.test_operators import plain_dedup, plain_fingerprint, plain_groups, plain_targets


def plain_mix(rows, seed=7):
    """{doc_id: copies} of rows (doc_id, text, source)."""
    sizes = {i: len((t or "").split()) for i, t, _ in rows}
    totals = {}
    for i, _, s in rows:
        totals[s] = totals.get(s, 0) + sizes[i]
    targets, out = plain_targets(totals), {}
    for s, total in totals.items():
        rate = targets[s] / total if total else 0.0
        key = hashlib.md5(f"{seed}:{'n' if s is None else 's' + s}".encode()).hexdigest()
        offset = int(key[:8], 16) / 2**32
        mine = sorted((i for i, _, x in rows if x == s), key=lambda i: (
            math.floor(math.log(sizes[i] + 1.0) * 32), hashlib.md5(str(i).encode()).hexdigest()))
        for k, i in enumerate(mine):
            out[i] = math.floor((k + 1) * rate + offset) - math.floor(k * rate + offset)
    return {i: c for i, c in out.items() if c}


def corpus(rng):
    items = [(k, data.prose(rng, 30)) for k in range(5)]
    rows = []
    for i in range(300):
        text = data.lines(rng, rng.randint(4, 9))
        kind = i % 12
        if kind == 1:
            words = text.split(" ")
            words.insert(rng.randrange(1, len(words)), rng.choice(data.TOXIC))
            text = " ".join(words)
        elif kind == 2 and i > 24:
            text = rows[i - 24][1]  # an exact copy
        elif kind == 3 and i > 24:
            text = "\n".join(rows[i - 24][1].split("\n")[:3]) + "\n" + text  # a shared passage
        elif kind == 4:
            text = text + "\n" + rng.choice(items)[1]  # a benchmark item
        elif kind == 5 and i > 24:
            head, _, tail = rows[i - 24][1].partition("\n")
            text = head + " again\n" + tail  # a near copy
        rows.append((i, text, "en", rng.choice(["a", "b", "c", None])))
    return rows, items


def test_pipeline_equals_plain_stages(spark, tmp_path):
    rng = random.Random(21)
    rows, items = corpus(rng)
    toxic = {i for i, t, _, _ in rows if set(t.lower().replace(".", " ").split()) & set(data.TOXIC)}
    folder = data.write(tmp_path / "t", data.documents(rows, ()),
                        [(r[0], 1, int(r[0] in toxic)) for r in rows], items)
    left = [r for r in rows if r[0] not in toxic]
    left = [(r[0], t, *r[2:]) for r, t in zip(left, plain_dedup([r[1] for r in left]))]
    groups = plain_groups([r[0] for r in left], [plain_fingerprint(r[1]) for r in left])
    left = [r for r in left if groups[r[0]] == r[0]]

    def holds(text, item):
        plain = lambda t: "".join(c if c.isalnum() else " " for c in t.lower()).split()
        w, v = plain(text), plain(item)
        have = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        windows = [tuple(v[i:i + 5]) for i in range(len(v) - 4)]
        return sum(x in have for x in windows) >= 0.8 * len(windows)

    left = [r for r in left if not any(holds(r[1], t) for _, t in items)]
    assert 0 < len(left) < len(rows) - len(toxic)
    copies = plain_mix([(r[0], r[1], r[3]) for r in left])
    got = corpus_pipeline.run(spark, folder).collect()
    texts = {r[0]: r[1] for r in left}
    assert all(r.text == texts[r.doc_id] for r in got)
    counts = {}
    for r in got:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == copies
