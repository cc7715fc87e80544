"""Quality rules, language model, URL verdicts, chat texts and the pipeline."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from odd_rows import documents, none, odd  # noqa: F401
from tidewater.llm import chat, fertility, language_model, url_filter
from tidewater.llm.queries import URL_RULES
from tidewater.llm.storage import staged
from tidewater.llm.words import LOWER as LOWER_BYTES, VISIBLE, words

SPLIT = "[ \t-\r]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    text = text or ""
    words = [w for w in re.split(SPLIT, text) if w]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search("[^ \t-\r]", x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_base_counts(documents, odd, none):
    frame = documents.select("doc_id", "text", "lang").unionByName(odd.where("doc_id <> 6").select("doc_id", "text", "lang"))
    rows = fertility.judged(frame).collect()
    want = sorted((str(r.doc_id), *base(r.text)) for r in frame.collect())
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept) for r in rows)
    assert fertility.judged(none).count() == 0 and fertility.judged(odd).count() == odd.count()


def test_bands_reject_symbols(spark):
    import random

    rng = random.Random(1)
    say = lambda: " ".join(rng.choice(["river", "stone", "of", "the", "walks", "under", "morning", "light", "seven", "houses"]) + rng.choice(["", "", ",", "s"]) + str(i % 7) for i in range(200))
    rows = [(i, say(), "en") for i in range(200)] + [(1000, " ".join(w + "$$$&&&" for w in say().split()), "en")]
    got = {r.doc_id: r for r in fertility.judged(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert not got[1000].kept and got[1000].reasons and sum(not r.kept and not r.base_failed for d, r in got.items() if d < 1000) <= 4


def test_every_document_has_a_band(spark):
    """Symbol soup below 128 tokens, in a language of one document, and in a table of few documents."""
    import random

    rng = random.Random(8)
    say = lambda n: " ".join(rng.choice(["river", "stone", "of", "the", "walks", "under", "morning", "light", "seven", "houses"]) + rng.choice(["", "", ",", "s"]) + str(i % 7) for i in range(n))
    soup = lambda n: " ".join("".join(rng.choice("\u0a85\u1c90\u2d30\ua4d0\u16a0") for _ in range(3)) + str(i) for i in range(n))
    for many in (200, 20):
        rows = [(i, say(200), "en") for i in range(many)] + [(500 + i, say(30), "en") for i in range(many)]
        rows += [(1000, soup(11), "en"), (1001, soup(150), "xx"), (1002, soup(150), "en"), (1003, say(200), "yy")]
        frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
        got = {r.doc_id: r for r in fertility.judged(frame).collect()}
        assert got[1000].n_tokens < fertility.LEAST_TOKENS and not got[1000].base_failed
        assert len(got) == len(rows) and all(not got[d].kept and got[d].reasons for d in (1000, 1001, 1002)), got[1000]
        assert got[1003].kept and sum(not r.kept and not r.base_failed for d, r in got.items() if d < 1000) <= many // 25


def plain_scores(lm, counts, tokens, scores):
    """The same model, word by word: a product of choices, each with its own softmax."""
    m, tree, t = lm.model, language_model.Tree(len(lm.model.classes.words)), lm.totals
    ranked = {h: k for h, k in zip(m.classes.words.tolist(), m.classes.number.tolist())}
    number = lambda word: ranked.get(int(words(pa.array([word])).hash[0]), 0)
    start, end = tree.borders()
    for doc_id, ws in tokens:
        if str(doc_id) not in scores:
            continue
        before, total = [m.classes.end + 1] * 2, 0.0
        for word in ws:
            k = m.classes.end if word == "\n" else number(word)
            r = m.context[before[1]] * m.weight[0] + m.context[before[0]] * m.weight[1]
            top, deep, group, leaf = tree.path(np.array([k]))
            for e in (top[0], *group, *leaf):
                s = (m.target[start[e] : end[e]] @ r + m.bias[start[e] : end[e]]).astype(float)
                total += (s[e - start[e]] - math.log(np.exp(s).sum())) / math.log(10)
            if k == 0:
                total += math.log10(counts[word] + 0.5) - math.log10(t.other_tokens + 0.5 * (t.other_distinct + 1))
            before = [before[1], k]
        assert math.isclose(scores[str(doc_id)], total, rel_tol=1e-4, abs_tol=1e-3), doc_id


def test_language_model_grows():
    assert [language_model.least_count(n) for n in (0, 4_000_000, 64_000_000)] == [2, 2, 16]
    assert [language_model.shards_of(d, 1000) for d in (0, 1, 1_000_001, 50_000_000)] == [1, 1, 2, 50]
    assert language_model.shards_of(50_000_000, 10_000_000) == 1


def test_language_model_shards(spark):
    """A round has as many training tasks as shards, whatever the session's setting."""
    drawn = staged(spark.range(3_000).selectExpr("int(id % 7) w", "1 one", "2 two", "int(xxhash64(id) & 2147483647) key"), "draws")
    for shards in (1, 5, 40):
        parts = [language_model.dealt(drawn, turn, 3, shards) for turn in range(3)]
        assert [p.rdd.getNumPartitions() for p in parts] == [shards] * 3
        assert sum(p.count() for p in parts) == 3_000


def test_language_model(documents, odd, none):
    frame = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    held = language_model.held_out("doc_id")
    lm = language_model.fit(frame.where(~held))
    rows = language_model.scored(frame, lm).withColumn("held_out", held).collect()
    tokens = [(r.doc_id, [w for w in re.split(SPLIT, (r.text or "").translate(LOWER)) if w] + ["\n"]) for r in frame.collect()]
    out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    c = Counter(w for d, ws in tokens if not out(d) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), out(d), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 4)) for d, ws in tokens)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-6, abs_tol=1e-3)
    prose = [r for r in rows if r.held_out and r.n_tokens > 20]
    assert sum(r.score for r in prose) > sum(r.base_score for r in prose)
    classes = lm.model.classes
    every = np.arange(classes.end + 1)
    for a, b in ((0, 1), (5, classes.end + 1)):
        assert math.isclose(np.exp(lm.model.logs(every, np.full(len(every), b), np.full(len(every), a))).sum(), 1, rel_tol=1e-4)
    times = Counter(str(r.doc_id) for r in rows)
    short = sorted((r for r in rows if times[str(r.doc_id)] == 1), key=lambda r: (r.n_tokens, str(r.doc_id)))[:40]
    plain_scores(lm, c, tokens, {str(r.doc_id): r.score for r in short})
    assert language_model.scored(none.select("doc_id", "text"), lm).count() == 0
    empty = language_model.fit(none)
    assert [r.base_score for r in language_model.scored(odd.where("doc_id = 4"), empty).collect()] == [0.0]


def host_path(url):
    _, at, rest = (url or "").partition("://")
    if not at:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def test_urls(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    extra = [(-1, None), (-2, "no scheme"), (-3, "http://ORG/x?y"), (-4, "http://a.example.org/es/1#x"), (-5, "http://notexample.org"), (-6, "x://é.com/fr/a://b"), (-7, ""), (None, "http://www.example.org/en/12"), (-8, "http://b.com/de/?" + "q=1&" * 5000)]
    frame = pages.unionByName(spark.createDataFrame(extra, "page_id bigint, url string")).selectExpr("*", "1 AS label", "2 AS host", "3 AS suffix")
    got = url_filter.judged(frame, URL_RULES).collect()
    want = []
    for r in frame.collect():
        host, path = host_path(r.url)
        fits = [(len(t), t, v) for v, t in URL_RULES if (host == t.split("/")[0] or host.endswith("." + t.split("/")[0])) and path.startswith(t[t.index("/") :])]
        want.append((str(r.page_id), host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None))
    key = lambda x: (x[0], x[1], x[2])
    for g, w in zip(sorted(((str(r.page_id), r.host, r.path, r.rule, r.verdict) for r in got), key=key), sorted(want, key=key), strict=True):
        assert g[:4] == w[:4] and g[4] == (w[4] or g[4]) and g[4] in ("allow", "block")
    ruled = [r for r in got if r.rule]
    assert sum((r.verdict == "block") == r.blocked_by_trees for r in ruled) >= 0.9 * len(ruled)
    assert {r.verdict for r in url_filter.judged(frame, [("block", "com/de/")]).collect() if not r.rule} == {"block"}
    assert url_filter.judged(frame.where("false"), URL_RULES).count() == 0


def test_reply_trees(spark):
    rows = [
        ("t", 1, None, "user", "root <|im_end|>\n<\\|x", 1.0),
        ("t", 2, 1, "assistant", "short", 1.0),
        ("t", 3, 1, "assistant", None, 5.0),
        ("t", 4, 3, "user\nodd\\n", "deep<", 1.0),
        ("t", 5, 2, "user", "tie", 5.0),
        ("t", 6, 99, "user", "orphan", None),
        ("t", 7, 8, "user", "circle", 1.0),
        ("t", 8, 7, "user", "circle", 1.0),
        (None, 1, None, "assistant", "alone", 0.0),
    ] + [("long", i, i - 1 or None, "user", str(i), 0.0) for i in range(1, 40)]
    m = spark.createDataFrame(rows, "tree string, node bigint, parent bigint, role string, text string, score double")
    got = {(r.tree, r.leaf): r for r in chat.read_back(chat.formatted(m, chat.best_paths(m))).collect()}
    assert set(got) == {("t", 4), ("t", 6), (None, 1), ("long", 39)}  # 4 and 5 tie in score and length, the smaller leaf wins
    turns = [tuple(x) for x in got["t", 4].turns]
    assert turns == [("user", "root <|im_end|>\n<\\|x"), ("assistant", ""), ("user\nodd\\n", "deep<")] and got["t", 4].learnt == [""]
    assert got[None, 1].learnt == ["alone"] and [x.text for x in got["long", 39].turns] == [str(i) for i in range(1, 40)]
    both = {(r.tree, r.leaf) for r in chat.best_paths(m, per_root=2).collect()}
    assert ("t", 5) in both and chat.best_paths(m.where("false")).count() == 0


def test_pipeline(spark, sf_dir, documents, none):
    cols = documents.columns
    frame, sizes = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = staged(stage(spark, frame, sf_dir), "stage")
        assert frame.columns == cols
        sizes.append(frame.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * documents.count()
    rows = corpus_pipeline.STAGES[-1][1](spark, frame, sf_dir)
    assert rows.select("doc_id").distinct().count() == frame.select("doc_id").distinct().count()
    empty = none.select(*cols)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


def test_pipeline_keeps_one_of_each_group(spark, sf_dir, odd):
    kept = corpus_pipeline.distinct_documents(spark, odd, sf_dir)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "None", "3", "4", "6", "7", "8", "9"])


def test_pipeline_near_duplicates(spark, sf_dir):
    """Three separate words replaced in 150: a similarity of 0.81 by five words."""
    text = [f"word{i}" for i in range(150)]
    copy = [f"other{i}" if i in (30, 70, 110) else w for i, w in enumerate(text)]
    rows = [(1, " ".join(text)), (2, " ".join(copy)), (3, " ".join(copy[:100] + text[20:60]))]
    kept = corpus_pipeline.distinct_documents(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), sf_dir)
    assert {r.doc_id for r in kept.collect()} == {1, 3}


@pytest.mark.parametrize("rounds", [1, 3])
def test_language_model_learns_from_every_token(spark, documents, odd, rounds):
    """The rounds' packets hold each training token once, with the two classes before it."""
    texts = documents.select("text").unionByName(odd.select("text")).unionByName(documents.select("text").limit(3))
    known = np.sort(np.unique(words(pa.array([" ".join(r.text or "" for r in texts.limit(40).collect())]), VISIBLE, LOWER_BYTES).hash))
    classes = language_model.Classes(known, np.arange(len(known)) + 1)
    want, got = Counter(), Counter()
    for r in texts.collect():
        w = words(pa.array([r.text], pa.string()), VISIBLE, LOWER_BYTES)
        _, token, one, two = language_model.sequences(w, 1, classes.of(w.hash), classes.end)
        want.update(zip(token.tolist(), one.tolist(), two.tolist()))
    keyed = language_model.keyed(texts)
    for turn in range(rounds):
        drawn = language_model.packets(keyed.where(F.col("key") % rounds == turn), classes, rounds)
        rows = language_model.dealt(drawn, turn, rounds, 2).collect()
        for r in rows:
            got.update(zip(*(x.tolist() for x in language_model.unpacked([bytes(r.tokens)], classes.end))))
    assert sum(got.values()) > 1000 and got == want


def test_shards_are_as_many_as_asked_for(spark, monkeypatch):
    """Also where a shuffle deals to more partitions than it was told."""
    frame = spark.range(1_000).withColumnRenamed("id", "key")
    real = type(frame).repartition
    monkeypatch.setattr(type(frame), "repartition", lambda self, n, *c: real(self, max(n, 16), *c))
    dealt = language_model.dealt(frame, 1, 3, 2)
    assert dealt.rdd.getNumPartitions() == 2 and dealt.count() == 333


def test_quality_rules_work_on_small_slices(spark, monkeypatch):
    """Texts are measured about a megabyte at a time, so that a worker's arrays stay small; verdicts do not depend on it."""
    from tidewater.llm import packing, words as places

    sizes = []
    real = fertility.base_counts
    monkeypatch.setattr(fertility, "base_counts", lambda column: sizes.append(sum(len(x.as_py() or "") for x in column)) or real(column))
    text = " ".join(f"word{i % 977}" for i in range(3000))
    batch = pa.record_batch([pa.array(range(200)), pa.array([text] * 200), pa.array(["en"] * 200)], ["doc_id", "text", "lang"])

    class Rows:
        def select(self, *columns):
            return self

        def mapInArrow(self, work, schema):
            return list(work(iter([batch])))

    out = fertility.measured(Rows())
    assert sum(b.num_rows for b in out) == 200 and len(sizes) > 3 and max(sizes) <= 1 << 20
    monkeypatch.setattr(fertility, "SLICE", places.SLICE_BYTES)
    assert pa.Table.from_batches(fertility.measured(Rows())).equals(pa.Table.from_batches(out).combine_chunks())
    assert packing.SLICE == 1 << 20


def test_language_model_sends_few_bytes():
    """Tokens in as many bytes as they need; a shard's rows in blocks of four bytes a number, at any place."""
    rng = np.random.default_rng(3)
    values = np.concatenate([[0, 1, 127, 128, 16383, 16384, 2097151, 2097152, 2**31 - 1, 2**33], rng.integers(0, 300, 5000)])
    raw, begin = language_model.short(values)
    got, last = language_model.long(np.frombuffer(raw, np.uint8))
    assert got.tolist() == values.tolist() and (last == begin[1:] - 1).all() and len(raw) < 2 * len(values)
    at = np.flatnonzero(rng.random(200_000) < 0.3)
    rows = rng.standard_normal((len(at), 17)).astype(np.float32)
    table = language_model.in_blocks(at, rows)
    assert sum(map(len, table.column("vectors").to_pylist())) == rows.nbytes and table.nbytes < 1.1 * rows.nbytes
    back, new = language_model.of_blocks(table, 17)
    assert (back == at).all() and (new == rows).all()
    assert len(language_model.of_blocks(language_model.in_blocks(at[:0], rows[:0]), 17)[0]) == 0


def test_means_of_shards(spark):
    """Each row is the mean over the shards that met it."""
    rows = np.arange(12, dtype=np.float32).reshape(4, 3)
    shards = [(np.array([0, 5, 3000, 70_000]), rows), (np.array([5, 70_000]), 10 * rows[:2])]
    frame = spark.createDataFrame(pa.concat_tables([language_model.in_blocks(*s) for s in shards]))
    at, new = language_model.of_blocks(language_model.means(frame, 3).toArrow(), 3)
    got = dict(zip(at.tolist(), new.tolist()))
    assert got == {0: [0, 1, 2], 5: [1.5, 7, 12.5], 3000: [6, 7, 8], 70_000: [19.5, 25, 30.5]}
