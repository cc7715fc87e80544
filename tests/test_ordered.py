"""Ordered operators against brute force, with and without keys too large for one task."""

import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators.ordered import ordered, range_frame, running, shift
from tidewater.operators.ranking import latest, nth_highest, ntile, quantiles, ranked, top_n

SMALL = 25  # rows per task, so that the busy key below is cut into slices


def sample(seed=7):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        key = 1 if i % 3 == 0 else rng.randrange(2, 40) if i % 7 else None
        rows.append((i, key, rng.randrange(0, 500), rng.choice([None, 1, 2, 3, 50])))
    return rows


def by_key(data):
    groups = {}
    for r in sorted(data, key=lambda r: (r[2], r[0])):
        groups.setdefault(r[1], []).append(r)
    return groups


@pytest.fixture(params=[SMALL, 1_000_000], ids=["sliced", "plain"])
def hot_rows(request):
    return request.param


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(sample(), "id long, k long, t long, v long").repartition(5)


def test_running_and_shift(frame, hot_rows):
    o = ordered(frame, ["k"], ["t", "id"], hot_rows=hot_rows)
    assert o.sliced == (hot_rows == SMALL)
    o = running(o, {"s": ("sum", F.col("v")), "n": ("count", F.lit(1)), "hi": ("max", F.col("v")), "lo": ("min", F.col("v"))})
    o = running(o, {"before": ("sum", F.col("v"))}, exclusive=True)
    o = running(o, {"after": ("max", F.col("v"))}, exclusive=True, reverse=True)
    o = shift(o, {"prev": F.col("v")}, ["t", "id"])
    o = shift(o, {"next": F.col("id")}, ["t", "id"], ahead=True)
    o = shift(o, {"prev0": F.col("t")}, ["t", "id"], default=F.lit(-1))
    got = {r["id"]: r for r in o.result().collect()}
    assert len(got) == 400
    for rows in by_key(sample()).values():
        for i, r in enumerate(rows):
            seen = [x[3] for x in rows[: i + 1] if x[3] is not None]
            past = [x[3] for x in rows[:i] if x[3] is not None]
            rest = [x[3] for x in rows[i + 1 :] if x[3] is not None]
            g = got[r[0]]
            assert g["s"] == (sum(seen) if seen else None)
            assert g["n"] == i + 1
            assert g["hi"] == (max(seen) if seen else None)
            assert g["lo"] == (min(seen) if seen else None)
            assert g["before"] == (sum(past) if past else None)
            assert g["after"] == (max(rest) if rest else None)
            assert g["prev"] == (rows[i - 1][3] if i else None)
            assert g["next"] == (rows[i + 1][0] if i + 1 < len(rows) else None)
            assert g["prev0"] == (rows[i - 1][2] if i else -1)


def test_running_over_the_whole_frame(frame, hot_rows):
    o = running(ordered(frame, [], ["t", "id"], hot_rows=hot_rows), {"n": ("count", F.lit(1))})
    got = {r["id"]: r["n"] for r in o.result().collect()}
    for i, r in enumerate(sorted(sample(), key=lambda r: (r[2], r[0]))):
        assert got[r[0]] == i + 1
    assert "SinglePartition" not in frame._sc._jvm.PythonSQLUtils.explainString(
        running(ordered(frame, ["k"], ["t", "id"], hot_rows=hot_rows), {"n": ("count", F.lit(1))}).df._jdf.queryExecution(), "simple"
    )


def test_ranked(frame, hot_rows):
    for keys in (["k"], []):
        kinds = {"r": "rank", "d": "dense_rank", "c": "cume_dist", "p": "percent_rank"}
        got = {r["id"]: r for r in ranked(frame, keys, "t", kinds, hot_rows=hot_rows).collect()}
        assert len(got) == 400
        groups = by_key(sample()) if keys else {0: sample()}
        for rows in groups.values():
            values = [r[2] for r in rows]
            for r in rows:
                above = sum(v > r[2] for v in values)
                g = got[r[0]]
                assert g["r"] == above + 1
                assert g["d"] == len({v for v in values if v > r[2]}) + 1
                assert g["c"] == pytest.approx(sum(v >= r[2] for v in values) / len(values))
                assert g["p"] == pytest.approx(above / (len(values) - 1) if len(values) > 1 else 0.0)


def test_ntile(frame, hot_rows):
    got = {r["id"]: r["q"] for r in ntile(frame, "t", "id", 7, "q", hot_rows=hot_rows).collect()}
    order = sorted(sample(), key=lambda r: (-r[2], r[0]))
    small, extra = divmod(400, 7)
    expect, at = {}, 0
    for b in range(7):
        for r in order[at : at + small + (b < extra)]:
            expect[r[0]] = b + 1
        at += small + (b < extra)
    assert got == expect


def test_quantiles(frame, hot_rows):
    import numpy as np

    got = {r["k"]: r for r in quantiles(frame, ["k"], "t", {"m": 0.5, "q": 0.9}, hot_rows).collect()}
    for k, rows in by_key(sample()).items():
        assert got[k]["m"] == pytest.approx(np.percentile([r[2] for r in rows], 50))
        assert got[k]["q"] == pytest.approx(np.percentile([r[2] for r in rows], 90))
    one = quantiles(frame, [], "t", {"m": 0.5}, hot_rows).collect()
    assert one[0]["m"] == pytest.approx(np.percentile([r[2] for r in sample()], 50))


def test_top_latest_nth(frame):
    data = by_key(sample())
    best = top_n(frame, ["k"], [F.desc("t"), F.asc("id")], 2).collect()
    assert {r["id"] for r in best} == {x[0] for rows in data.values() for x in sorted(rows, key=lambda r: (-r[2], r[0]))[:2]}
    last = latest(frame, ["k"], ["t", "id"]).collect()
    assert {r["id"] for r in last} == {rows[-1][0] for rows in data.values()}
    second = nth_highest(frame, ["k"], "v", 2).collect()
    expect = set()
    for rows in data.values():
        top = sorted({r[3] for r in rows if r[3] is not None}, reverse=True)
        expect |= {r[0] for r in rows if len(top) > 1 and r[3] == top[1]}
    assert {r["id"] for r in second} == expect


def test_top_n_trims_before_the_shuffle(frame):
    plan = frame._sc._jvm.PythonSQLUtils.explainString(
        top_n(frame, ["k"], [F.desc("t"), F.asc("id")], 2)._jdf.queryExecution(), "formatted"
    )
    assert "WindowGroupLimit" in plan


def test_range_frame(frame, hot_rows):
    outs = {"n": ("count", F.lit(1)), "s": ("sum", F.coalesce("v", F.lit(0)))}
    got = {r["id"]: r for r in range_frame(frame, ["k"], F.col("t"), 5, outs, hot_rows=hot_rows).collect()}
    assert len(got) == 400
    for rows in by_key(sample()).values():
        for r in rows:
            near = [x for x in rows if r[2] - 5 <= x[2] <= r[2]]
            assert got[r[0]]["n"] == len(near)
            assert got[r[0]]["s"] == sum(x[3] or 0 for x in near)


@pytest.mark.parametrize("most", [5, 50_000])
def test_select_quantiles(spark, most):
    import numpy as np

    from tidewater.operators.ranking import select_quantiles

    rng = random.Random(3)
    values = [float(rng.randrange(0, 5000)) for _ in range(20_000)] + [77.0] * 10_000 + [None] * 10
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = select_quantiles(df, "v", probs, most=most)
    clean = [v for v in values if v is not None]
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(clean, p))
    assert select_quantiles(df.where("v > 1e9"), "v", [0.5]) == {0.5: None}


def test_running_in_the_order_of_names(spark, hot_rows):
    rng = random.Random(11)
    names = ["".join(rng.choice("abzäß€") for _ in range(rng.randrange(0, 9))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(names)), "id long, s string").withColumn("k", F.lit(1)).repartition(3)
    got = running(ordered(df, ["k"], ["s", "id"], hot_rows=hot_rows), {"n": ("count", F.lit(1))}).result()
    want = sorted(range(200), key=lambda i: (names[i].encode(), i))
    assert {r["id"]: r["n"] for r in got.collect()} == {i: n + 1 for n, i in enumerate(want)}


@pytest.mark.parametrize("listed", [2, 10_000])
def test_any_number_of_hot_keys(spark, monkeypatch, listed):
    from tidewater.operators import ordered as O
    from tidewater.operators.skew import pairs_within, salted_join, split_hot_join

    monkeypatch.setattr(O.hot_keys, "__defaults__", (O.HOT_ROWS, listed))
    df = spark.range(600).selectExpr("id", "IF(id % 7 = 0, null, id % 6) AS k", "id * 37 % 101 AS v").repartition(4)
    got = running(ordered(df, ["k"], ["v", "id"], hot_rows=10), {"n": ("count", F.lit(1)), "s": ("sum", F.col("v"))}).result()
    own = {}
    for r in sorted(df.collect(), key=lambda r: (r.v, r.id)):
        own.setdefault(r.k, []).append(r)
    want = {r.id: (i + 1, sum(x.v for x in rows[: i + 1])) for rows in own.values() for i, r in enumerate(rows)}
    assert {r.id: (r.n, r.s) for r in got.collect()} == want
    small = spark.createDataFrame([(i, f"name {i}") for i in range(6)], "k long, name string")
    plain = sorted(map(tuple, df.join(small, "k").select("id", "name").collect()))
    assert sorted(map(tuple, salted_join(df, small, ["k"], F.col("id"), hot_rows=10).select("id", "name").collect())) == plain
    assert sorted(map(tuple, split_hot_join(df, small, "k", hot_rows=10).select("id", "name").collect())) == plain
    pairs = pairs_within(df.where("id < 120"), ["k"], "id", hot_rows=5)
    assert pairs.count() == sum(n * (n - 1) // 2 for n in (sum(r.id < 120 for r in rows) for k, rows in own.items() if k is not None))


def test_names_with_one_beginning_are_sliced(spark):
    df = spark.range(2000).selectExpr("1 AS k", "concat('Customer#', lpad(cast(id AS string), 9, '0')) AS s")
    o = ordered(df, ["k"], ["s"], hot_rows=100)
    sizes = [r["count"] for r in o.df.groupBy("__slice").count().collect()]
    assert len(sizes) > 16 and max(sizes) <= 200
