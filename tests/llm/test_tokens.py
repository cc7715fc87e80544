"""Counts, files and packing against plain tokenisation."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from odd_rows import documents, none, odd  # noqa: F401
from tidewater.llm import encoders, packing, token_counts, token_files


def plain(name, texts):
    model = Tokenizer.from_file(public_tokenizers.path(name))
    model.encode_special_tokens = True
    return [e.ids for e in model.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \n\t\u00a0\u2003\u3000aéÉ1'sS.,\u0301ß<|日🙂\x1c\r\u0085", max_size=40)), min_size=1, max_size=8))
def test_stretches_give_the_ids_of_the_whole_text(name, texts):
    ids, begin = encoders.encoder(name).encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(begin[:-1], begin[1:])] == plain(name, texts)


def test_a_full_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(encoders, "MOST_STRETCHES", 3)
    own = encoders.Encoder("byte_bpe_50k.json")
    for text in ("one two three four", "five one two", "six"):
        assert own.encode(pa.array([text]))[0].tolist() == plain("byte_bpe_50k.json", [text])[0]


def test_lengths(odd, none, documents):
    frame = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    sizes = [len(i) for i in plain("byte_bpe_50k.json", [r.text for r in frame.collect()])]
    table = token_counts.with_suffix_sums(token_counts.length_histogram(frame)).cache()
    rows = table.collect()
    assert sorted(r.n_tokens for r in rows) == sorted(set(sizes))
    for r in rows:
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least) == (sizes.count(r.n_tokens), sum(s >= r.n_tokens for s in sizes), sum(s for s in sizes if s >= r.n_tokens))
        assert (r.docs_cut, r.tokens_kept) == (sum(s > r.n_tokens for s in sizes), sum(min(s, r.n_tokens) for s in sizes))
    for r in token_counts.at_limits(table, [0, 1, 100, 2048, 10**7]).collect():
        assert (r.docs_cut, r.tokens_kept) == (sum(s > r.context for s in sizes), sum(min(s, r.context) for s in sizes))
    at = {r.share: r.n_tokens for r in token_counts.length_quantiles(table, [0.5, 1.0]).collect()}
    assert at[1.0] == max(sizes) and at[0.5] == sorted(sizes)[-(-len(sizes) // 2) - 1]
    assert token_counts.with_suffix_sums(token_counts.length_histogram(none)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 60), st.integers(0, 2**32 - 1)), max_size=300), st.sampled_from([1, 7, 64]), st.sampled_from([0, 50, 90, 100]))
def test_blocks_round_trip(values, block, percentile):
    ids = np.array(values, np.uint32)
    file = token_files.TokenFile(token_files.file_bytes([5, None], [len(ids), 0], ids, block, percentile))
    assert file.ids(0, len(ids)).tolist() == values and file.doc_ids == [5, None]
    half = len(ids) // 3
    assert file.ids(half, 2 * half).tolist() == values[half : 2 * half]


def test_files(spark, odd, none):
    files = token_files.write_token_files(odd, token_files.token_folder(spark), file_ids=1_000)
    assert files.count() > 1
    got = sorted((tuple(r) for r in token_files.read_token_files(files).collect()), key=lambda r: r[1])
    rows = odd.select("doc_id", "text").collect()
    want = {r.doc_id: np.array(i + [2], "<u4") for r, i in zip(rows, plain("word_bpe_49k.json", [r.text for r in rows]))}
    assert [r[0] for r in got] == sorted((r.doc_id for r in rows), key=lambda d: (d is not None, d))
    at = 0
    for doc, start, n, crc in got:
        assert (start, n, crc) == (at, len(want[doc]), zlib.crc32(want[doc].tobytes()))
        at += n
    empty = token_files.write_token_files(none, token_files.token_folder(spark))
    assert token_files.read_token_files(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_best_fit_is_tightest(sizes):
    number, offset = packing.best_fit_decreasing(np.array(sizes, np.int64), 64)
    left: list[int] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [r for r in left if r >= sizes[i]]
        if fits:
            assert 64 - offset[i] == min(fits)
            left[int(number[i])] -= sizes[i]
        else:
            assert number[i] == len(left) and offset[i] == 0
            left.append(64 - sizes[i])


def test_packing(odd, none):
    rows = odd.select("doc_id", "text").collect()
    want = [(r.doc_id, np.array(i + [1], "<u4")) for r, i in zip(rows, plain("byte_bpe_50k.json", [r.text for r in rows]))]
    packed = packing.packed_documents(odd, shard=7)
    got = packed.collect()
    pieces = sorted((str(d), at, min(2048, len(o) - at), zlib.crc32(o[at : at + 2048].tobytes()), len(o)) for d, o in want for at in range(0, len(o), 2048))
    assert sorted((str(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == pieces
    windows: dict[int, list] = {}
    for r in got:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in windows.values():
        ends = [0, *[a + n for a, n in sorted(held)]]
        assert ends[-1] <= 2048 and [a for a, _ in sorted(held)] == ends[:-1]
    assert packing.padding(packed).first()["tokens"] == sum(len(o) for _, o in want)
    assert packing.packed_documents(none).count() == 0
