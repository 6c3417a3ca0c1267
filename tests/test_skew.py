"""A third of the rows on one key: results stay exact (checked by brute
force), with the shuffle paths forced instead of broadcasts."""

import bisect
import random
from collections import Counter

import pytest

from quarry.operators import cleaning as C
from quarry.operators import metrics as M
from quarry.operators import text as T
from tests.conftest import plan_text


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _skewed_rows(n=30000, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        pid = 0 if i % 3 == 0 else rnd.randrange(1, 2000)   # id 0 holds a third
        sparse = rnd.random() < 0.3
        rows.append((pid, None if sparse else 1.0, None if sparse else "x",
                     None if sparse or rnd.random() < 0.5 else 2.0))
    return rows


def test_semi_join_hot_id_sort_merge(spark, no_broadcast):
    rows = _skewed_rows()
    df = spark.createDataFrame(rows, "id long, a double, s string, b double").repartition(6)
    out = C.semi_join_healthy_ids(df, "id")
    assert "SortMergeJoin" in plan_text(out) or "SortMergeJoin" in plan_text(out, "extended")
    healthy_ids = {r[0] for r in rows if sum(v is None for v in r) < 2}
    want = Counter(r for r in rows if r[0] in healthy_ids)
    got = Counter(tuple(r) for r in out.collect())
    assert got == want


def test_word_count_hot_word(spark):
    rnd = random.Random(1)
    words = [("the" if i % 3 == 0 else f"w{rnd.randrange(500)}") for i in range(30000)]
    lines = [" ".join(words[i:i + 10]) for i in range(0, len(words), 10)]
    docs = spark.createDataFrame([(i, "\n".join(lines[i:i + 7])) for i in range(0, len(lines), 7)],
                                 "doc_id long, text string")
    got = {r["word"]: r["cnt"] for r in T.word_count(T.tokenize(T.text_lines(docs))).collect()}
    assert got == dict(Counter(words))
    # map-side partial aggregation before the exchange
    plan = plan_text(T.word_count(T.tokenize(T.text_lines(docs))))
    assert plan.count("HashAggregate") >= 2


def test_auc_hot_score_multi_bucket(spark):
    rnd = random.Random(2)
    pts = [(0.5 if i % 3 == 0 else rnd.random(), float(rnd.random() < 0.4)) for i in range(9000)]
    df = spark.createDataFrame(pts, "score double, label double").repartition(5)
    got = M.auc_roc(df, ranges=16).first()["auc"]
    pos = [s for s, y in pts if y == 1.0]
    neg = sorted(s for s, y in pts if y != 1.0)
    num = sum(bisect.bisect_left(neg, s) + 0.5 * (bisect.bisect_right(neg, s)
                                                  - bisect.bisect_left(neg, s)) for s in pos)
    assert got == pytest.approx(num / (len(pos) * len(neg)), abs=1e-12)


def test_confusion_hot_class(spark):
    rows = [(1.0, 1.0)] * 10000 + [(0.0, 1.0), (1.0, 0.0), (0.0, 0.0)] * 3000
    df = spark.createDataFrame(rows, "prediction double, label double").repartition(7)
    r = M.confusion_counts(df).first()
    assert (r["tp"], r["fn"], r["fp"], r["tn"]) == (10000, 3000, 3000, 3000)


def test_auc_ranges_do_not_collapse_on_a_hot_score(spark):
    # 99 % of the rows on one score: the other scores still fill several ranges.
    df = spark.createDataFrame([(0.5 if i % 100 else i / 1e4, 1.0) for i in range(10000)],
                               "s double, y double")
    from pyspark.sql import functions as F
    per = df.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    assert M.score_ranges(per, 8).select("bk").distinct().count() >= 6


def test_healthy_rows_are_not_moved_by_the_id_filter(spark):
    """Only rows that are not healthy themselves meet the ids in the join."""
    df = spark.createDataFrame([(i % 50, 1.0, None if i % 10 == 0 else 2.0, None if i % 10 == 0 else 3.0)
                                for i in range(1000)] + [(None, None, None, None)], "id long, a double, b double, c double")
    out = C.semi_join_healthy_ids(df, "id")
    healthy = C.healthy_row(df)
    ids = {r.id for r in df.filter(healthy).collect()}
    want = [r for r in df.collect() if r.id in ids]
    assert sorted(map(repr, out.collect())) == sorted(map(repr, want))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union")
