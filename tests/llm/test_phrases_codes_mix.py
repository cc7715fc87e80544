"""Collocations, vector codes and mixing against plain versions."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_rows import documents, none, odd  # noqa: F401

from tidewater.llm import mixing, phrases, vector_codes

# ---- collocations ----


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def counted_plainly(rows, longest=5):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lowered(text)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    return f, n


def collocated_plainly(rows, least, best):
    f, n = counted_plainly(rows)
    wanted = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    inside = defaultdict(int)
    for (lang, w), a in wanted.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                inside[lang, w[i : i + k]] = max(inside[lang, w[i : i + k]], a)
    scored = defaultdict(list)
    for (lang, w), a in wanted.items():
        if 100 * inside[lang, w] >= 100 * a:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
        s, _, left, right = min(cuts)
        scored[lang].append((-s, -a, " ".join(w).encode(), left, right))
    return {(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, rows_ in scored.items() for i, (s, a, p, left, right) in enumerate(sorted(rows_)[:best])}


def test_collocations(spark, odd, documents):
    docs = documents.select("text", "lang").unionByName(odd.select("text", "lang"))
    rows = [tuple(r) for r in docs.collect()]
    for least, best in ((20, 2000), (3, 40)):
        got = {tuple(r) for r in phrases.collocations(docs, least=least, best=best).collect()}
        assert got == collocated_plainly(rows, least, best) and got


@pytest.mark.parametrize("trigger", [1, 2, 16, 1 << 40])
def test_every_phrase_is_counted_once_wherever_chunks_are_cut(spark, trigger):
    rows = [("a b a b a b a b a b, a b\tc  d e f g h", "x"), ("A B a b a é日 b\r\nc d e f g", None), ("a b a b", "x"), (None, "x"), ("", "x"), (" ,. ", "und"), ("a " * 3000, "und"), ("z", "x")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    found, words = phrases.frequent_phrases(docs, least=1, trigger=trigger)
    f, n = counted_plainly(rows)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in found.collect()} == dict(f)
    assert {r.lang: r.n for r in words.collect()} == {k: v for k, v in n.items() if v}


def test_copies_are_one_chunk(spark):
    docs = spark.createDataFrame([("the same passage of words stands in every text of this table. it has pieces", "en")] * 500, "text string, lang string")
    chunks = phrases.chunk_dictionary(docs).collect()
    assert len(chunks) < 12 and {c.n for c in chunks} == {500}
    top = phrases.collocations(docs).collect()
    assert all(r.a == 500 for r in top) and len(top) == 8 + 1  # ten and three words; only the longest phrases stay


def test_scores_beyond_64_bits(spark, monkeypatch):
    big = 3_000_000_000_000
    held = spark.createDataFrame([("x", "a", 1, 5 * big), ("x", "b", 1, 7 * big), ("x", "a b", 2, big)], "lang string, phrase string, size int, f bigint")
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *a: (held, spark.createDataFrame([("x", 40 * big)], "lang string, n bigint")))
    row = phrases.collocations(None).first()
    assert row.score == 1000 * big * 40 * big // (35 * big * big)


def test_no_collocations(none):
    assert phrases.collocations(none).count() == 0


# ---- vector codes ----


def coded_plainly(rows, parts=8, entries=16, rounds=6):
    kept = [(i, v, lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = -(-len(kept[0][1]) // parts)
    whole = [[max(-(2**62), min(2**62, math.floor(4096 * x))) for x in v] + [0] * (parts * width - len(v)) for _, v, _ in kept]
    cut = [[w[p * width : (p + 1) * width] for p in range(parts)] for w in whole]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        fresh = []
        for p in range(parts):
            groups = defaultdict(list)
            for c in cut:
                groups[near(c[p], books[p])[1]].append(c[p])
            fresh.append([[sum(col) // len(groups[k]) for col in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])])
        books = fresh
    out = []
    for (i, _, lab), c in zip(kept, cut):
        best = [near(c[p], books[p]) for p in range(parts)]
        out.append((i, tuple(k for _, k in best), min(sum(d for d, _ in best), 2**63 - 1), lab))
    return out, books


VECTORS = "vec_id bigint, embedding array<float>, label int"


def check_codes(spark, rows, **how):
    frame = spark.createDataFrame(rows, VECTORS).repartition(3).selectExpr("*", "1 AS part", "2 AS code", "3 AS error", "4 AS codes")
    rows = [tuple(r) for r in frame.select("vec_id", "embedding", "label").collect()]
    want, books = coded_plainly(rows, **how)
    fitted = vector_codes.fit(frame, **how)
    assert [t.tolist() for t in fitted.entries] == books
    codes = vector_codes.encoded(frame, fitted, keep=("label",)).cache()
    assert sorted(((r.vec_id, tuple(r.codes), r.error, r.label) for r in codes.collect()), key=repr) == sorted(want, key=repr)
    totals = defaultdict(int)
    for _, _, e, lab in want:
        totals[lab] += e
    assert {(r.label, r.label_error) for r in vector_codes.with_label_error(codes).collect()} == {(k, min(v, 2**63 - 1)) for k, v in totals.items()}
    return codes, fitted


def test_vector_codes(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").limit(150).collect()]
    rows += [(1000 + i, rows[3][1], 1) for i in range(60)]  # copies
    rows += [(2000, None, 1), (2001, [None] + [0.5] * 63, 1), (2002, [float("nan")] + [0.5] * 63, 1), (2003, [float("-inf")] + [0.5] * 63, None), (2004, [], 2), (2005, [1.0, 2.0], 2)]
    rows += [(None, [0.25] * 64, None), (2006, [-1.5] * 64, None), (2006, [-1.5] * 64, None), (2007, [1e4] * 64, 5)]
    codes, fitted = check_codes(spark, rows)
    near = {r.vec_id: r for r in vector_codes.decoded(codes, fitted).collect() if r.vec_id is not None}
    held = {r[0]: r[1] for r in rows}
    row = near[rows[3][0]]
    off = sum((math.floor(4096 * a) - round(4096 * b)) ** 2 for a, b in zip(held[rows[3][0]], row.vector))
    assert len(row.vector) == 64 and off == row.error


def test_few_odd_or_huge_vectors(spark):
    check_codes(spark, [(1, [0.5] * 11, 1), (2, [-0.5] * 11, None)])
    check_codes(spark, [(i, [float(i % 7) * 10.0**e for e in range(12)], i % 2) for i in range(40)], entries=4, rounds=3)
    check_codes(spark, [(i, [1e30 * (i % 3), -1e30, 3.0, 1e-30], i % 2) for i in range(20)], parts=2, entries=3)


def test_no_vectors(spark):
    assert vector_codes.fit(spark.createDataFrame([(1, None, 1)], VECTORS)) is None
    assert vector_codes.fit(spark.createDataFrame([], VECTORS)) is None


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 60), st.integers(1, 4), st.integers(1, 9), st.sampled_from([3, 1 << 30]))
def test_the_trie_finds_the_nearest(seed, n, width, leaves, top):
    draw = np.random.default_rng(seed)
    values = np.unique(draw.integers(-top, top, (n, width)), axis=0)
    book = draw.integers(-top, top, (5, width))
    code, distance = vector_codes.nearest(values, book, leaves)
    for v, c, d in zip(values.tolist(), code, distance):
        assert (d, c) == min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book.tolist()))


# ---- mixing ----


def targets_plainly(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    fixed = {}
    while True:
        rest = [s for s in names if s not in fixed]
        share = (sum(sizes.values()) - sum(fixed.values())) / max(1, sum(weight[s] for s in rest))
        over = [s for s in rest if weight[s] * share > 3 * sizes[s]]
        if not over:
            return {**{s: weight[s] * share for s in rest}, **fixed}
        fixed.update({s: 3 * sizes[s] for s in over})


def check_mix(docs, **how):
    rows = [tuple(r) for r in docs.select("doc_id", "source", "text").collect()]
    sizes, longest = defaultdict(int), defaultdict(int)
    for _, s, text in rows:
        n = len(re.findall("[^ \t-\r]+", text or ""))
        sizes[s] += n
        longest[s] = max(longest[s], n)
    want = targets_plainly(sizes)
    got = mixing.mixed(docs, **how).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.size) for r in got) == sorted((i if i is not None else -1, len(re.findall("[^ \t-\r]+", t or ""))) for i, _, t in rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert r.taken == r.times * r.size and 0 <= r.times <= 3
        assert not r.source_size or math.floor(r.target / r.source_size - 1e-6) <= r.times <= math.ceil(r.target / r.source_size + 1e-6)
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s]
    return {(r.doc_id, r.size): r.times for r in got}, taken, want


def test_mixing(documents, odd):
    docs = documents.unionByName(odd.select(*documents.columns))
    first, _, _ = check_mix(docs)
    again, _, _ = check_mix(docs.repartition(5))
    assert first == again


def test_a_source_in_many_blocks_stays_near_its_target(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', concat('s', id % 5)) AS source", "repeat('w ', cast(1 + pmod(hash(id), 200) AS int)) AS text")
    first, taken, want = check_mix(docs, block=40)
    for s, target in want.items():
        assert abs(taken[s] - target) < 10  # the landing has some small documents to choose from
    assert first != check_mix(docs, block=40, seed=2)[0]


def test_chances_and_document_counts_hold(spark):
    sizes = np.arange(1, 61) ** 2
    hits = np.zeros(60)
    for seed in range(400):
        draw = np.random.default_rng(seed)
        ends = mixing.flight(np.full(60, 0.3), sizes[::-1], draw)
        left = (ends > 0) & (ends < 1)
        assert left.sum() <= 2 and math.isclose(ends.sum(), 18, abs_tol=1e-6) and math.isclose((ends * sizes[::-1]).sum(), 0.3 * sizes.sum(), rel_tol=1e-6)
        hits += ends
        whole = mixing.landing(np.full(60, 0.3), sizes[::-1], draw)
        assert set(whole) <= {0.0, 1.0} and abs((whole * sizes[::-1]).sum() - 0.3 * sizes.sum()) < 60
    assert abs(hits / 400 - 0.3).max() < 0.1


def test_mixed_edges(spark, none):
    assert mixing.mixed(none).count() == 0
    schema = "doc_id bigint, text string, source string"
    check_mix(spark.createDataFrame([(1, None, "a"), (2, "", None)], schema))  # no words at all
    check_mix(spark.createDataFrame([(1, "one", "a"), (1, "one", "a"), (None, "two words", None), (None, None, "b")], schema))
    check_mix(spark.createDataFrame([(i, "same size", "a") for i in range(50)] + [(99, "w " * 900, "b")], schema))


def test_fetched_documents(documents):
    mix = mixing.mixed(documents).cache()
    copies = mixing.fetched(documents, mix)
    assert copies.count() == mix.selectExpr("sum(times)").first()[0] and set(copies.columns) == {*documents.columns, "copy"}
