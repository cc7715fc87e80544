"""Line dedup, Jaccard join, components and decontamination against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_rows import documents, none, odd  # noqa: F401
from tidewater.llm import decontaminate, graphs, jaccard_join, line_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def joined(pairs, nodes):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1_000, 1_060)] + [(7, 7)]
    got = {r.node: r.root for r in graphs.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    want = joined(pairs, {n for p in pairs for n in p})
    assert got == {n: r for n, r in want.items() if n != r}
    assert graphs.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def shingles(text):
    w = [x for x in re.split("[ \t-\r]+", (text or "").translate(LOWER)) if x]
    return set(zip(w, w[1:], w[2:])) if len(w) > 2 else ({tuple(w)} if w else set())


def near_copies():
    """Families of near copies, some at the very threshold, and one large family around a text that links them."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    out = []
    for family in range(25):
        base = [word() for _ in range(rng.choice([9, 12, 20, 60, 200]))]
        out.append(" ".join(base))
        for _ in range(rng.randrange(8)):
            copy = list(base)
            for _ in range(rng.randrange(1, 4)):
                copy[rng.randrange(len(copy))] = word()
            out.append(" ".join(copy[: len(copy) - rng.randrange(2)]))
    base = [word() for _ in range(150)]
    for _ in range(60):
        copy = list(base)
        for _ in range(2):
            copy[rng.randrange(150)] = word()
        out.append(" ".join(copy))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("block", [3_000, 5])
def test_jaccard_components(spark, odd, block):
    rows = [(100 + i, t) for i, t in enumerate(near_copies())] + [(r.doc_id, r.text) for r in odd.collect() if r.doc_id is not None]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"), block=block).collect()
    sets = {d: shingles(t) for d, t in rows}
    ids = sorted(sets)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    want = joined(pairs, ids)
    assert len(got) == len(rows) and {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(d, len(sets[d]), want[d]) for d in ids}


def test_jaccard_odd_rows(odd, none):
    got = {(r.doc_id, r.component_id) for r in jaccard_join.jaccard_components(odd).collect()}
    assert {(4, 4), (5, 4), (1, 1), (2, 2), (7, 7)} <= got and jaccard_join.jaccard_components(none).count() == 0


def test_bound_excludes_no_link():
    import numpy as np

    rng = np.random.default_rng(2)
    for _ in range(200):
        n, k = int(rng.integers(9, 400)), int(rng.integers(0, 12))
        left = rng.integers(0, 2**63, n, dtype=np.uint64)
        right = np.concatenate([left[: n - k], rng.integers(0, 2**63, int(rng.integers(0, k + 1)), dtype=np.uint64)])
        sets, sizes = np.concatenate([np.sort(left), np.sort(right)]), np.array([len(left), len(right)])
        shared = n - k
        linked = 100 * shared >= 90 * (n + len(right) - shared)
        row, keys = jaccard_join.bucket_keys(sets, sizes, jaccard_join.Levels(90))
        assert not linked or n == len(right) == shared or set(keys[row == 0]) & set(keys[row == 1])


def test_bound_excludes_no_link_at_80():
    import numpy as np

    rng = np.random.default_rng(3)
    levels = jaccard_join.Levels(80)
    for _ in range(200):
        n = int(rng.integers(5, 900))
        k = int(rng.integers(0, n // 8 + 2))
        left = rng.integers(0, 2**63, n, dtype=np.uint64)
        right = np.concatenate([left[: n - k], rng.integers(0, 2**63, int(rng.integers(0, k + 1)), dtype=np.uint64)])
        sets, sizes = np.concatenate([np.sort(left), np.sort(right)]), np.array([len(left), len(right)])
        shared = n - k
        linked = 100 * shared >= 80 * (n + len(right) - shared)
        row, keys = jaccard_join.bucket_keys(sets, sizes, levels)
        assert not linked or n == len(right) == shared or set(keys[row == 0]) & set(keys[row == 1])


def test_line_classes(spark, documents, odd, none):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8)))
    rows = []
    for family in range(60):
        base = [word() for _ in range(rng.randrange(12, 60))]
        for copy in range(rng.randrange(1, 5)):
            line = list(base)
            if copy:
                line[rng.randrange(len(line))] = word()
            rows.append((len(rows), " ".join(line) + "\nshort\n" + " ".join(base if copy % 2 else line)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.line_no): (r.first_doc, r.first_line) for r in line_dedup.line_classes(frame).collect()}
    lines = {(d, i): x.encode() for d, t in rows for i, x in enumerate(t.split("\n")) if len(x.encode()) >= line_dedup.LEAST}
    sets = {x: {x[k : k + 8] for k in range(len(x) - 7)} for x in lines.values()}
    held = defaultdict(list)
    for x in sets:
        for s in sets[x]:
            held[s].append(x)
    links = {(a, b) for group in held.values() for a in group for b in group if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    top = joined(links, sets)
    first: dict = {}
    for at in sorted(lines):
        first.setdefault(top[lines[at]], at)
    same = sum(first[top[x]] == got[at] for at, x in lines.items())
    assert set(got) == set(lines) and same >= 0.97 * len(lines)  # the search is probabilistic, links are verified
    assert all(got[at] in first.values() or got[at] <= at for at in lines)
    kept = {r.doc_id: r.text for r in line_dedup.without_repeated_lines(odd).collect()}
    assert kept[3] == "same line here, long enough to compare" and 5 not in kept and kept[4] and kept[2] is None and kept[7] is not None
    assert line_dedup.without_repeated_lines(odd).columns == odd.columns
    assert line_dedup.line_classes(none).count() == 0 and line_dedup.without_repeated_lines(none).count() == 0


def test_bands_find_short_and_late_edits(spark):
    """Lines of 30 to 40 shingles and a similarity of 0.82, unlike in their last bytes, and long ones unlike far behind their beginning."""
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    rows = []
    for pair in range(800):
        n, m = ((30, 3), (40, 4), (200, 20))[pair % 3]
        base = text(n + 7 - m)
        rows += [(2 * pair, base + text(m)), (2 * pair + 1, base + text(m))]
    lines = spark.createDataFrame(rows, "id bigint, line string")
    found = line_dedup.candidate_pairs(line_dedup.buckets(line_dedup.signatures(lines.select("line"))))
    name = {r.h: r.id for r in lines.selectExpr("id", "xxhash64(line) AS h").collect()}
    hit = {name[r.a] // 2 for r in found.collect() if name[r.a] // 2 == name[r.b] // 2}
    for kind in range(3):
        assert sum(p % 3 == kind for p in hit) >= 0.95 * sum(p % 3 == kind for p in range(800))


@pytest.mark.parametrize("block", [500, 7])
def test_pairs_inside_a_template(spark, block):
    """Families of two lines at 0.92 that share a template, lines of different families being below 0.8."""
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    shared = text(168)
    lines = []
    for family in range(150):
        own = text(31)
        lines += [shared + own + text(8), shared + own + text(8)]
    table = spark.createDataFrame([(x,) for x in lines], "line string")
    members = line_dedup.buckets(line_dedup.signatures(table))
    name = {r.h: lines.index(r.line) for r in table.selectExpr("line", "xxhash64(line) AS h").collect()}
    met = {}
    for r in members.collect():
        met.setdefault(name[r.line_hash], set()).add(r.key)
    want = {k for k in range(0, 300, 2) if met.get(k, set()) & met.get(k + 1, set())}
    root = {name[r.node]: name[r.root] for r in line_dedup.linked_lines(table, block=block).collect()}
    top = lambda k: root.get(k, k)
    assert len(want) >= 147 and all(top(k) == top(k + 1) for k in want)
    assert all(top(k) // 2 == k // 2 for k in range(300))


def test_short_lines_are_compared(spark):
    rows = [(1, "Accept all cookies\nMenu\n\n日本語\n \t\nfirst of all lines"), (2, "Accept all cookies\nMenu\n\n日本語\n \t\nsecond among them"), (3, "menu")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.line_no): (r.first_doc, r.first_line, r.copies, r.kept) for r in line_dedup.line_classes(frame).collect()}
    assert set(got) == {(1, 0), (1, 1), (1, 3), (1, 5), (2, 0), (2, 1), (2, 3), (2, 5), (3, 0)}
    assert all(got[2, n] == (1, n, 2, False) and got[1, n] == (1, n, 2, True) for n in (0, 1, 3))
    assert got[3, 0] == (3, 0, 1, True) and got[2, 5][3]
    assert {r.doc_id: r.text for r in line_dedup.without_repeated_lines(frame).collect()}[2] == "\n \t\nsecond among them"


def test_contamination_odd_rows(spark, odd, none):
    items = spark.createDataFrame([("a", "Quick! BROWN fox"), ("b", None), (None, "lazy dog and"), ("c", ""), ("a", "Quick! BROWN fox"), ("d", "over the lazy dog and runs away from it all and more")], "item_id string, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(odd, items).collect()}
    assert (got[4].n_words, got[4].n_hit, got[4].n_items, got[4]["items"]) == (15, 13, 2, ["a", "d"])
    assert got[2].n_words == 0 and not got[2].contaminated and got[2]["items"] == []
    assert decontaminate.contamination(none, items).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(odd, items.where("false")).collect())


def test_signatures_of_long_lines(spark):
    """Cut into pieces, a line has the minima over all its shingles."""
    rng = random.Random(12)
    sizes = (7, 8, 9, 14, 15, 16, 17, 254, 255, 256, 257, 263, 264, 1000, 20_000)
    lines = ["".join(rng.choice("abcdefgé ") for _ in range(n)) for n in sizes]
    table = spark.createDataFrame([(x,) for x in lines * 2], "line string")
    got = {r.line_hash: list(r)[1:] for r in line_dedup.signatures(table).collect()}
    plain = spark.createDataFrame([(x, x.encode()[k : k + 8]) for x in lines for k in range(len(x.encode()) - 7)], "line string, shingle binary")
    hashed = defaultdict(list)
    for r in plain.select(F.xxhash64("line").alias("line_hash"), F.hash("shingle").alias("h")).collect():
        hashed[r.line_hash].append(r.h & line_dedup._BITS)
    assert got == {x: [min((h * f + s) & line_dedup._BITS for h in hs) for f, s in line_dedup._MAPS] for x, hs in hashed.items()}


@pytest.mark.parametrize("home", [2_000_000, 400])
def test_sets_are_sent_once(spark, monkeypatch, home):
    """Pairs are verified where the sets of a group of near copies are, each sent there once; a large group has several places."""
    monkeypatch.setattr(jaccard_join, "HOME", home)
    rng = random.Random(13)
    rows, pairs = [], set()
    for group in range(40):
        base = [rng.choice("abcdefghijklmnop") + str(rng.randrange(99)) for _ in range(60)]
        members = 60 if group == 7 else rng.randrange(2, 5)
        for k in range(members):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(60)] = "x" + str(rng.randrange(10**6))
            rows.append((1000 * group + k, " ".join(own)))
        pairs |= {(1000 * group, 1000 * group + k) for k in range(1, members)} | {(1000 * group + k, 1000 * group + k + 1) for k in range(members - 1)}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    points = jaccard_join.sketches(docs, "doc_id", "text", 3, jaccard_join.LOWER)
    asked = spark.createDataFrame(sorted(pairs), "a bigint, b bigint")
    placed = jaccard_join.at_home(asked, points).collect()
    assert sorted((r.a, r.b) for r in placed) == sorted(pairs)
    sent = {(d, r.home) for r in placed for d in (r.a, r.b)}
    assert len(sent) <= len(rows) + (200 if home < 1000 else 60)
    assert home > 1000 or len({r.home for r in placed if r.a // 1000 == 7}) > 3
    shingles = {d: {tuple(w[k : k + 3]) for k in range(58)} for d, t in rows for w in [t.split()]}
    want = {(a, b) for a, b in pairs if 100 * len(shingles[a] & shingles[b]) >= 80 * len(shingles[a] | shingles[b])}
    got = jaccard_join.verified(asked, points, docs, "doc_id", "text", 3, 80, jaccard_join.LOWER)
    assert 20 < len(want) < len(pairs) and {(r.a, r.b) for r in got.collect()} == want


def test_fine_points_exclude_no_link_and_tell_unlike_sets_apart():
    rng = np.random.default_rng(5)
    fresh = lambda n: np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1))
    for size in (1_025, 3_000, 20_000):
        own, other = fresh(size), fresh(size)
        assert not jaccard_join.may_link(jaccard_join.fine_point(own), jaccard_join.fine_point(other), 80)
        for share in (0.85, 0.95, 1.0):
            near = np.sort(np.concatenate([own[: int(share * len(own))], other[: int((1 - share) * len(own))]]))
            shared = len(np.intersect1d(own, near))
            linked = 100 * shared >= 80 * (len(own) + len(near) - shared)
            assert not linked or jaccard_join.may_link(jaccard_join.fine_point(own), jaccard_join.fine_point(near), 80)
    assert jaccard_join.fine_point(fresh(900)) is None


def test_small_graphs_take_few_tasks(spark, monkeypatch):
    """However many partitions a shuffle has, a round of a small graph is written by a handful of tasks."""
    written = []
    monkeypatch.setattr(graphs, "staged", lambda df, label, real=graphs.staged: written.append(real(df, label)) or written[-1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edges = spark.range(1_000).selectExpr("id as a", "id + 1 as b").where("b % 100 <> 0")
        got = {r.node: r.root for r in graphs.components(edges).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {n: n // 100 * 100 for n in range(1_001) if n % 100 and n <= 999}
    assert max(len(w.inputFiles()) for w in written[1:]) <= 4


def test_unlike_lines_of_a_bucket_are_told_apart_by_their_parities(spark, monkeypatch):
    rng = random.Random(9)
    own = ["".join(rng.choices("abcdefghijklmnop", k=300)) for _ in range(40)]
    lines = spark.createDataFrame([(x,) for x in own + [x[:-1] + "!" for x in own[:3]]], "line string")
    members = lines.select(F.lit(1).cast("bigint").alias("key"), F.lit(0).alias("band"), F.xxhash64("line").alias("line_hash"))
    seen = []
    monkeypatch.setattr(line_dedup, "similar_lines", lambda table, pairs, s, real=line_dedup.similar_lines: seen.append(pairs.count()) or real(table, pairs, s))
    none_yet = spark.createDataFrame([], "node bigint, root bigint")
    got = {frozenset((r.a, r.b)) for r in line_dedup.missing_links(lines, members, none_yet, block=7).collect()}
    named = {r.line: r.line_hash for r in lines.select("line", F.xxhash64("line").alias("line_hash")).collect()}
    assert got == {frozenset((named[x], named[x[:-1] + "!"])) for x in own[:3]}
    assert seen == [3]


def test_lines_alone_in_their_class_are_their_own_heads(spark, monkeypatch):
    """Only classes of several lines are looked up."""
    heads = {}
    monkeypatch.setattr(line_dedup, "staged", lambda df, label, real=line_dedup.staged: heads.setdefault(label, real(df, label)))
    frame = spark.createDataFrame([(1, "alone in this one\nsaid twice"), (2, "said twice\nanother line by itself")], "doc_id bigint, text string")
    got = {(r.doc_id, r.line_no): (r.first_doc, r.first_line, r.copies, r.kept) for r in line_dedup.line_classes(frame).collect()}
    assert got == {(1, 0): (1, 0, 1, True), (1, 1): (1, 1, 2, True), (2, 0): (1, 1, 2, False), (2, 1): (2, 1, 1, True)}
    assert heads["heads"].count() == 1


def test_hashes_of_lines_wrap_around(spark):
    """The MinHash arithmetic is not checked for overflow, which took a third of its time; what the session says stays."""
    line = spark.createDataFrame([("a line of more than eight bytes",)], "line string")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    table = line_dedup.signatures(line)
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert sum(x >= 0 for x in table.first()[1:]) == line_dedup.BANDS * line_dedup.ROWS  # would overflow 32 bits if checked


def test_bands_are_dealt_in_few_bytes(spark):
    """A bucket's member is a key, a hash and one number below 2^40, which holds the next band's key and the band."""
    rows = [(f"{k:03} lines that are much alike and fill a bucket {k // 2}",) for k in range(40)]
    table = line_dedup.signatures(spark.createDataFrame(rows, "line string"))
    members = line_dedup.buckets(table)
    assert {r.band for r in members.select("band").distinct().collect()} <= set(range(line_dedup.BANDS))
    assert members.where("next < 0 OR next >= shiftleft(1L, 32)").isEmpty() and not members.isEmpty()
    same = members.alias("x").join(members.alias("y"), F.expr("x.line_hash = y.line_hash AND y.band = (x.band + 1) % 8"))
    assert same.where("x.next <> shiftrightunsigned(y.key, 32)").isEmpty()
