"""Bit packing round trips, and token files against direct encoding."""

import zlib

import numpy as np
import pytest
from common_rows import awkward, frame, ids
from hypothesis import given, settings
from hypothesis import strategies as st

from envlake.llm import bitpack as B
from envlake.llm.queries import tokenizer

ODD = ["", " ", "  a b", "it's  o'k\n\n x", "a\tb  c", "ñandú 12 34abc\n", "x \n y", "日本 語 mix ab日本 c", " lead", "trail ", "\n\nq", "a_b __ c",
       "'tis ’quote’ … end", " \tfoo \t bar", " it's x'd", " a\n\n b\n \n c", "<|endoftext|> x", "αβγ abγ d", "é combining", "١٢ ٣", "a\x00b", "\x1c x"]


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=300))
@settings(max_examples=100, deadline=None)
def test_pack_round_trip(bits, ids):
    x = np.array([i % (1 << bits) for i in ids], np.uint32)
    data = B.pack(x, bits)
    assert len(data) == (len(x) * bits + 7) // 8 and (B.unpack(data, len(x), bits) == x).all()


def test_width():
    assert [B.width(n) for n in (1, 2, 3, 256, 257, 50257, 65537)] == [1, 1, 2, 8, 9, 16, 17]


@pytest.mark.parametrize("bits", [7, 16, 17])
def test_file_gives_any_range(bits):
    rnd = np.random.default_rng(bits)
    docs = [rnd.integers(0, 1 << bits, n).astype(np.uint32) for n in (0, 5, 40, 1, 300)]
    f = B.TokenFile(B.encode_file(docs, bits, 3, block=32))
    flat = np.concatenate(docs)
    assert (f.shard, f.n_docs, f.n_tokens) == (3, 5, len(flat))
    for i, d in enumerate(docs):
        assert (f.document(i) == d).all()
    for a, b in ((0, 346), (31, 33), (64, 64), (300, 346)):
        assert (f.ids(a, b) == flat[a:b]).all()
    empty = B.TokenFile(B.encode_file([], bits, 0))
    assert empty.n_tokens == 0 and len(empty.ids(0, 0)) == 0


def direct(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer().path)
    return [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_names_of_added_tokens_are_those_tokens():
    texts = ["a <|endoftext|> b", "plain words here", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n", "<|endoftext", ""]
    got = [x.tolist() for x in tokenizer()._load()(texts)]
    assert got == direct(texts) and got[0] == [64, 220, 50256, 275]


@pytest.mark.parametrize("memo", [0, 3, 800_000])
def test_memo_encodes_like_the_library(memo, monkeypatch):
    monkeypatch.setattr(B, "MEMO", memo)
    texts = ODD + [" ".join(ODD), "\n".join(ODD), "Plain words, and more words.\nNext line: 42 words"] * 2
    run = tokenizer()._load()
    got = [list(x) for k in range(0, len(texts), 7) for x in run(texts[k:k + 7])]
    assert got == direct(texts)


@given(st.text(alphabet=st.sampled_from(list("aB é'\n\t.,1_-日 ")), max_size=40))
@settings(max_examples=300, deadline=None)
def test_pieces_put_together_are_the_text(text):
    assert "".join(B._pieces(text)) == text


@given(st.lists(st.text(alphabet=st.sampled_from(list("aB é'\n\t.,1_-日 ")), max_size=25), max_size=6))
@settings(max_examples=60, deadline=None)
def test_any_text_encodes_like_the_library(texts):
    assert [list(x) for x in tokenizer().load()(texts)] == direct(texts)


def test_files_hold_the_documents_in_order(spark, tmp_path, monkeypatch):
    texts = (ODD + ["word " * 50]) * 3
    df = spark.createDataFrame([(len(texts) - i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    folder = f"file://{tmp_path}/tokens"
    got = {r.doc_id: r for r in B.token_index(df, tokenizer(), folder, partitions=4).collect()}
    start = 0
    for i in sorted(got):
        want = direct([texts[len(texts) - i]])[0] + [0]
        crc = zlib.crc32(np.array(want, "<u4").tobytes())
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(want), crc)
        start += len(want)
    files = [B.TokenFile(p.read_bytes()) for p in (tmp_path / "tokens").glob("shard-*.tkb")]
    assert len(files) > 1 and sum(f.n_tokens for f in files) == start and {f.bits for f in files} == {16}
    assert not list((tmp_path / "tokens").glob(".*part*"))


def test_small_files_follow_each_other(spark, tmp_path):
    """Several files a task, as for a large partition."""
    df = spark.createDataFrame([(i, "some words here") for i in range(40)], "doc_id long, text string").repartition(1)
    written = B.write_token_files(df, f"file://{tmp_path}/t", tokenizer(), partitions=2, file_tokens=10)
    back = B.read_token_files(spark, f"file://{tmp_path}/t")
    assert written.select("shard").distinct().count() > 2 and back.count() == 40
    got = B.token_index(df, tokenizer(), f"file://{tmp_path}/u", partitions=2, file_tokens=10).orderBy("doc_id").collect()
    assert [r.start for r in got] == [i * got[0].n_tokens for i in range(40)]


def test_awkward_rows(spark):
    got = B.token_index(frame(spark), tokenizer())
    assert ids(got) == ids(frame(spark))
    rows = got.orderBy("start").collect()
    assert rows[0].doc_id is None and rows[0].start == 0  # null ids first
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    assert [r.n_tokens for r in rows if r.doc_id in (2, 3)] == [1, 1]
    assert len(awkward()) == len(rows) and B.token_index(frame(spark, []), tokenizer()).count() == 0
