"""Near-duplicate groups, index search, event patterns, sketches, frames and parity against plain versions."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidewater.operators import near_duplicates, parity, search_index, sequences, sketches
from tidewater.operators.control import plan_text
from tidewater.operators.graphs import components
from tidewater.operators.ordered import range_frame
from tidewater.operators.sequences import Step
from tidewater.operators.text import bm25, fulltext_search


def roots_of(nodes, links):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)] + [(7, 200 + i) for i in range(30)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a int, b int")).collect()}
    want = {n: r for n, r in roots_of({x for e in links for x in e}, links).items() if n != r}
    assert got == want
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0
    assert components(spark.createDataFrame([(1, 1)], "a int, b int")).count() == 0


def grams(s):
    s = f"  {s.lower()} "
    return {s[i : i + 3] for i in range(len(s) - 2)}


def test_near_duplicate_groups(spark):
    draw = random.Random(5)
    texts = ["".join(draw.choice("abcdefgh ") for _ in range(30)) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(texts)]
    for t in texts[:12]:  # chains of small edits
        for _ in range(4):
            at = draw.randrange(30)
            t = t[:at] + draw.choice("xyz") + t[at + 1 :]
            rows.append((len(rows), t))
    rows += [(1000 + i, texts[3].upper()) for i in range(150)]  # a third are copies
    rows += [(2000 + i, f"template number {i:04d} of the same kind and make") for i in range(40)]
    rows += [(3000, None), (3001, ""), (3002, ""), (None, "no key"), (3003, "ab"), (3004, "ab"), (1, texts[5])]
    frame = spark.createDataFrame(rows, "id int, name string").repartition(4)
    for threshold in (0.6, 0.8):
        held = [(i, n) for i, n in rows if i is not None]
        by_text = defaultdict(list)
        for i, n in held:
            if n:
                by_text[n.lower()].append(i)
        reps = {t: min(ids) for t, ids in by_text.items()}
        links = [(reps[a], reps[b]) for a, b in itertools.combinations(reps, 2) if len(grams(a) & grams(b)) >= threshold * len(grams(a) | grams(b)) - 1e-9]
        # texts of one record id stand for the same node
        root = roots_of(set(reps.values()), links)
        want = Counter((i, root[reps[n.lower()]] if n else i) for i, n in held)
        for block in (20_000, 7):
            got = near_duplicates.near_duplicate_groups(frame, "id", F.col("name"), threshold, block=block)
            assert Counter(map(tuple, got.collect())) == want
    assert near_duplicates.near_duplicate_groups(frame.where("false"), "id", F.col("name")).count() == 0


def test_bands_reach_the_recall_asked(spark):
    for threshold, rows in ((0.5, 2), (0.8, 4), (0.9, 6)):
        bands = near_duplicates.bands_for(threshold, rows)
        assert (1 - threshold**rows) ** bands <= near_duplicates.MISSED
    # sets of 90 shingles of which 80 are common: 0.8
    pairs = spark.range(400).select("id", F.transform(F.sequence(F.lit(0), F.lit(99)), lambda x: F.xxhash64(x, "id")).alias("all"))
    n = near_duplicates.bands_for(0.8, 4) * 4
    values = lambda s: F.array(*near_duplicates.min_hashes(s, n))
    both = pairs.select(values(F.slice("all", 1, 90)).alias("x"), values(F.slice("all", 11, 90)).alias("y")).collect()
    equal = [[a == b for a, b in zip(r.x, r.y)] for r in both]
    assert abs(sum(map(sum, equal)) / (400 * n) - 0.8) < 0.02  # independent values, each equal in eight of ten sets
    assert sum(any(all(e[i : i + 4]) for i in range(0, n, 4)) for e in equal) >= 399


# ---- index ----


@pytest.fixture(scope="module")
def texts(spark):
    draw = random.Random(9)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "the", "of"]
    rows = [(i, " ".join(draw.choices(words, [1, 2, 3, 4, 5, 6, 60, 40], k=draw.randrange(1, 60)))) for i in range(600)]
    rows += [(700, None), (701, ""), (702, "Alpha, of THE beta!"), (703, "alpha " * 500), (None, "alpha beta")]
    return spark.createDataFrame(rows, "id long, body string").repartition(4)


@pytest.fixture(scope="module")
def index(texts):
    return search_index.build_index(texts, "id", "body", buckets=8, cell_docs=20)


def test_postings_hold_every_word_once(texts, index):
    terms = ["alpha", "the"]
    want = {(t, r.id): [i for i, w in enumerate(re.findall("[a-z]+", r.body.lower())) if w == t] for r in texts.collect() if r.id is not None and r.body for t in terms}
    got = {(r.term, r.doc): list(r.positions) for r in index.postings(terms).collect()}
    assert got == {k: v for k, v in want.items() if v}
    assert index.n_docs == 604


def test_index_gives_the_rows_of_the_scan(texts, index):
    named = texts.where("id IS NOT NULL").fillna("")
    queries = {1: ["alpha"], 2: ["alpha", "beta", "the"], 3: ["nothing"], 4: ["of", "the"], 5: ["zeta", "nothing"]}
    for k in (1, 7, 1000):
        rounded = lambda df: sorted((r["query"], r["rank"], r["id"], round(r["score"], 6)) for r in df.collect())
        assert rounded(search_index.bm25_search(index, queries, k, "id")) == rounded(bm25(named, "id", "body", queries, k))
    for must, phrase, without in ((["alpha"], None, []), (["alpha", "beta"], "of the", ["gamma"]), (["the"], "alpha of the beta", []), (["alpha"], "nothing of", []), (["zeta"], "the the of", ["beta", "eps"])):
        want = [tuple(r) for r in fulltext_search(named, "id", "body", must, phrase, without, 8).collect()]
        got = search_index.with_headline(search_index.search(index, must, phrase, without, 8), texts, "id", "body", must[0])
        assert [tuple(r) for r in got.select("id", "rank_score", "headline").orderBy(F.desc("rank_score"), "id").collect()] == want


def test_a_search_reads_the_folders_of_its_terms(index):
    plan = plan_text(index.postings(["alpha"]).select("doc", "tf"))
    folder = index.spark.range(1).select(search_index._bucket(F.lit("alpha"), 8)).first()[0]
    assert re.search(rf"PartitionFilters: .*bucket#\d+ (IN \({folder}\)|= {folder})", plan) and re.search(r"PushedFilters: .*alpha", plan)
    assert "positions" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_cells_that_cannot_reach_the_best_are_skipped(index, monkeypatch):
    seen = []
    scored = search_index._scored
    monkeypatch.setattr(search_index, "_scored", lambda i, q, t, cells: seen.append(cells.count()) or scored(i, q, t, cells))
    search_index.bm25_search(index, {1: ["alpha"]}, 2)
    assert seen[1] <= 4 < index.blocks(["alpha"]).count()


def test_an_index_is_kept_until_its_files_change(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([(1, "one two")], "id long, body string").write.parquet(path)
    first = search_index.index_of(spark.read.parquet(path), "id", "body")
    assert search_index.index_of(spark.read.parquet(path), "id", "body") is first
    spark.createDataFrame([(2, "two three")], "id long, body string").write.mode("append").parquet(path)
    second = search_index.index_of(spark.read.parquet(path), "id", "body")
    assert second.n_docs == 2 and [r.doc for r in search_index.search(second, ["three"]).collect()] == [2]


# ---- patterns ----


@pytest.fixture(scope="module")
def clicks(spark):
    draw = random.Random(4)
    rows, n = [], 0
    for user, size in ((1, 300), (2, 40), (3, 1), (None, 30), (5, 25)):
        at = 1_700_000_000
        for _ in range(size):
            at += draw.choice([0, 1, 5, 60])
            n += 1
            rows.append((user, at, n, draw.choice("abc")))
    frame = spark.createDataFrame(rows + [(6, None, 0, None)], "user int, at long, id int, kind string").repartition(5)
    return rows, frame.withColumn("ts", F.timestamp_seconds("at").cast("timestamp_ntz"))


@pytest.mark.parametrize("how", [{}, {"hot_rows": 20, "chunk": 7}], ids=["plain", "sliced"])
@pytest.mark.parametrize("pattern", ["a.*?b", "ab", "aa.*?cb", "abbb", "a.*?a.*?a", "[ab].*?c"])
def test_patterns(clicks, pattern, how):
    rows, frame = clicks
    a, b, c = (F.col("kind") == k for k in "abc")
    steps = {
        "a.*?b": [Step(a), Step(b)], "ab": [Step(a), Step(b, "next")], "aa.*?cb": [Step(a), Step(a, "next"), Step(c), Step(b, "next")],
        "abbb": [Step(a), Step(b, "next", times=3)], "a.*?a.*?a": [Step(a, times=3)], "[ab].*?c": [Step(a | b), Step(c)],
    }[pattern]
    own = defaultdict(list)
    for user, at, n, kind in rows:
        own[user].append((at, n, kind))
    want = {u: (len(e), len(re.findall(pattern, "".join(k for *_, k in sorted(e))))) for u, e in own.items()} | {6: (1, 0)}
    got = sequences.sequence_counts(frame, "user", "ts", "id", steps, **how)
    assert {r.user: (r.events, r.matches) for r in got.collect()} == want


@pytest.mark.parametrize("how", [{}, {"hot_rows": 20, "chunk": 7}], ids=["plain", "sliced"])
def test_a_gap_in_time(clicks, how):
    rows, frame = clicks
    own = defaultdict(list)
    for user, at, n, kind in rows:
        own[user].append((at, n, kind))
    want = {u: sum(x[2] == "a" and y[2] == "b" and y[0] - x[0] <= 5 for x, y in itertools.pairwise(sorted(e))) for u, e in own.items()} | {6: 0}
    got = sequences.sequence_counts(frame, "user", "ts", "id", [Step(F.col("kind") == "a"), Step(F.col("kind") == "b", "next", within=5)], **how)
    assert {r.user: r.matches for r in got.collect()} == want


def test_a_pattern_reads_its_rows_once(spark, tmp_path, clicks):
    path = str(tmp_path / "e")
    clicks[1].write.parquet(path)
    events = spark.read.parquet(path)
    steps = [Step(F.col("kind") == k) for k in "abcab"]
    plan = plan_text(sequences.sequence_counts(events, "user", "ts", "id", steps, hot_rows=20), "simple")
    assert plan.count("FileScan") == 1
    with pytest.raises(ValueError):
        sequences.sequence_counts(events, "user", "ts", "id", [])


# ---- sketches ----


@pytest.fixture(scope="module")
def visits(spark):
    draw = random.Random(2)
    rows = [(d, f"u{min(draw.randrange(1, 400), draw.randrange(1, 400))}" if i % 3 else "hot", float(draw.randrange(1000))) for d in range(14) for i in range(400)]
    rows += [(3, None, None), (20, None, None)]
    return rows, spark.createDataFrame(rows, "d int, who string, v double").repartition(6)


def test_count_min(visits):
    rows, frame = visits
    week = F.floor(F.col("d") / 7).alias("w")
    cells, heap = sketches.count_min_states(frame, [F.col("d")], "who", epsilon=0.02, depth=4)
    assert cells.groupBy("d").count().agg(F.max("count")).first()[0] <= 4 * math.ceil(math.e / 0.02)
    cells, heap = sketches.merge_count_min(cells, heap, [week])
    exact = Counter((d // 7, w) for d, w, _ in rows if w)
    asked = frame.sparkSession.createDataFrame([*exact, (0, "nobody"), (9, "hot")], "w long, who string")
    got = {(r.w, r.who): r.estimate for r in sketches.count_min_estimates(cells, asked, ["w"], "who", 0.02, 4).collect()}
    over = [got[k] - exact[k] for k in got]
    assert len(got) == len(exact) + 2 and min(over) >= 0 and sum(o > 0.02 * 2800 for o in over) <= len(over) * math.exp(-4) + 1 and got[9, "hot"] == 0
    top = sketches.heavy_hitters(cells, heap, ["w"], "who", 0.2, 0.02, 4).collect()
    assert {(r.w, r.who) for r in top} == {(0, "hot"), (1, "hot")} and all(r.total == 2800 for r in top)


def test_quantile_states(visits):
    rows, frame = visits
    states = sketches.quantile_states(frame, [F.col("d")], "v")
    merged = sketches.merge_quantiles(states, [F.floor(F.col("d") / 7).alias("w")], {"q10": 0.1, "q99": 0.99})
    for r in merged.collect():
        own = [v for d, _, v in rows if v is not None and d // 7 == r.w]
        assert r.n == len(own)
        for q, p in ((r.q10, 0.1), (r.q99, 0.99)):
            assert sum(v < q for v in own) <= (p + 0.01) * len(own) and sum(v <= q for v in own) >= (p - 0.01) * len(own)
    assert merged.count() == 2  # a key of nulls has no quantile


def test_set_states(visits):
    rows, frame = visits
    states = sketches.set_states(frame, [F.col("d")], "who")
    own = defaultdict(set)
    for d, w, _ in rows:
        own[d] |= {w} - {None}
    for r in sketches.set_changes(states, "d", F.col("d") + 1).collect():
        before = own.get(r.d - 1)
        assert r.size == len(own[r.d])
        assert (r.kept, r.gained, r.lost) == ((None,) * 3 if before is None else (len(before & own[r.d]), len(own[r.d] - before), len(before - own[r.d])))


# ---- frames ----


@pytest.mark.parametrize("back", [0, 3, 1000])
def test_frames_are_the_same_at_every_size(spark, back):
    draw = random.Random(back)
    values = [0.001, 1e16, None, 2.5, 1e-12, 7.0]
    rows = [(i, "hot" if i % 3 else draw.choice(["x", None]), draw.choice([None, *range(-20, 60)]) if i % 9 else None, draw.choice(values)) for i in range(300)]
    rows += [(1000 + i, "hot", 12, 3.0) for i in range(100)]  # one position of many rows
    frame = spark.createDataFrame(rows, "id int, k string, at int, v double").repartition(4)
    outs = {"s": ("sum", F.col("v")), "n": ("count", F.col("v")), "hi": ("max", F.col("v")), "lo": ("min", F.col("v"))}
    got = [{r.id: r for r in range_frame(frame, ["k"], F.col("at"), back, outs, hot_rows=h).collect()} for h in (30, 10**9)]
    for i, k, at, v in rows:
        near = [x[3] for x in rows if x[1] == k and x[3] is not None and (x[2] is None if at is None else x[2] is not None and at - back <= x[2] <= at)]
        want = (sum(near), len(near), max(near), min(near)) if near else (None, 0, None, None)
        for r in (g[i] for g in got):
            assert (r.k, r.at, r.v) == (k, at, v)
            assert (r.n, r.hi, r.lo) == want[1:] and (r.s is None) == (not near) and (not near or math.isclose(r.s, want[0], rel_tol=1e-9))
    assert all(len(g) == len(rows) for g in got)
    whole = [range_frame(frame, [], F.col("at"), back, {"n": ("count", F.lit(1))}, hot_rows=h).agg(F.sum("n")).first()[0] for h in (30, 10**9)]
    assert whole[0] == whole[1]


def test_steps_over_slices_read_twice_at_most(spark, tmp_path):
    from tidewater.operators.patterns import window_funnel

    path = str(tmp_path / "e")
    spark.range(400).selectExpr("id", "id % 2 AS user", "timestamp_seconds(id) AS ts", "concat('s', id % 5) AS kind").write.parquet(path)
    events = spark.read.parquet(path)
    scans = []
    for n in (2, 4, 5):
        steps = [F.col("kind") == f"s{i}" for i in range(n)]
        plan = plan_text(window_funnel(events, "user", "ts", "id", steps, 100, hot_rows=50), "simple")
        scans.append(plan.count("FileScan") + plan.count("Scan ExistingRDD"))
        assert window_funnel(events, "user", "ts", "id", steps, 100, hot_rows=50).select("level").distinct().collect()[0][0] == n
    assert scans[1] == scans[2] and max(scans) <= 4  # the rows twice, and the cut points


# ---- parity ----


def test_parity(spark, tmp_path):
    schema = "k int, part string, v double, s string"
    rows = [(i, "p", float(i), "x" if i % 7 else None) for i in range(3000)] + [(None, None, 1.0, None), (5, "q", 1.0, "two"), (5, "q", 1.0, "two")]
    other = [r for r in rows if r[0] not in (17, 18)]
    other = [(k, p, v + (k == 40), s) for k, p, v, s in other if k is not None] + [(None, None, 2.0, None), (9000, "p", 0.0, "new"), (5, "q", 1.0, "two")]
    left, right = (spark.createDataFrame(r, schema).repartition(4) for r in (rows, other))
    want = {(17, "p", "only_left"), (18, "p", "only_left"), (40, "p", "differs"), (None, None, "differs"), (9000, "p", "only_right"), (5, "q", "differs")}
    keys, compared = ["k", "part"], ["v", "s"]
    assert {tuple(r) for r in parity.differing_keys(left, right, keys, compared).collect()} == want
    assert parity.differing_keys(left, left, keys, compared).count() == 0
    assert parity.differing_keys(left.where("false"), left, keys, compared).count() == left.select(*keys).distinct().count()
    sums = [parity.checksums(df, keys, compared) for df in (left, right)]
    found, compared_nodes = parity.differing_buckets(*sums)
    assert len(found) <= 6 and sum(compared_nodes) < 400  # of 4096 buckets
    for name, df in (("l", left), ("r", right)):
        df.withColumn("b", parity.bucket_of(keys, 64)).write.partitionBy("b").parquet(str(tmp_path / name))
    stored = [spark.read.parquet(str(tmp_path / n)) for n in "lr"]
    pruned = parity.differing_keys(*stored, keys, compared, 64, bucket="b")
    assert {tuple(r) for r in pruned.collect()} == want
    folders = re.findall(r"PartitionFilters: \[b#\d+ IN \(([\d,]+)\)", plan_text(pruned, "simple"))
    assert folders and all(len(f.split(",")) <= 6 for f in folders)
