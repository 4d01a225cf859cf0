"""The pipeline against its operators in plain Python, stage by stage."""

import zlib

import numpy as np
import pytest
from common_rows import frame

import __spark_entry__ as E
import corpus_pipeline as P
from envlake.llm import decontam, mixing, queries, simhash
from envlake.llm.bitpack import HfTokenizer
from envlake.llm.common import DOC_COLUMNS, table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    docs, out = table(spark, SF, "documents"), {}
    for name, f in P.STAGES:
        f(spark, docs, SF).write.parquet(f"{root}/{name}")
        docs = out[name] = spark.read.parquet(f"{root}/{name}")
    return out


def rows(df):
    return {r.doc_id: tuple(r) for r in df.select(*DOC_COLUMNS).collect()}


def test_registered():
    assert {"pipeline", *queries.QUERIES} <= set(E.queries()) and set(queries.ORACLE_SQL) <= set(E.oracle_sql())
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "decontamination", "mixture", "token_ids"]


def test_quality_keeps_what_the_query_predicts(spark, stages):
    want = {r.doc_id for r in queries.op10_quality(spark, SF).collect() if r.predicted}
    all_ = rows(table(spark, SF, "documents"))
    assert rows(stages["quality"]) == {i: all_[i] for i in want}


def test_one_of_each_group_stays(stages):
    before = rows(stages["quality"])
    fps = {i: simhash.fingerprint(r[1].encode() if r[1] is not None else None, 3) for i, r in before.items()}
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    order = sorted(fps)
    for n, a in enumerate(order):
        for b in order[:n]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert set(rows(stages["near_duplicates"])) == {i for i in fps if find(i) == i}


def test_contaminated_go(spark, stages):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    index = decontam.ItemIndex(items, decontam.Q, decontam.MAX_ERROR)
    before = rows(stages["near_duplicates"])
    plain = {i: " ".join("".join(c if c.isalnum() or ord(c) > 127 else " " for c in t.lower()).split()) for i, t in items}
    kept = rows(stages["decontamination"])
    assert set(kept) == {i for i, r in before.items() if not index.search(r[1])} and len(kept) < len(before)
    for r in kept.values():
        text = " ".join("".join(c if c.isalnum() or ord(c) > 127 else " " for c in r[1].lower()).split())
        assert not any(p in text for p in plain.values())


def test_mixture_keeps_all_in_order(spark, stages):
    assert rows(stages["mixture"]) == rows(stages["decontamination"])
    place = {r.doc_id: (r.slot, r.place) for r in mixing.mix(stages["decontamination"]).collect()}
    stored = stages["mixture"].selectExpr("doc_id", "_metadata.file_name f", "_metadata.row_index r").orderBy("f", "r").collect()
    assert [place[x.doc_id] for x in stored] == sorted(place.values())


def test_tokens_are_in_the_mixed_order(stages):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(queries.tokenizer().path)
    text = {i: r[1] for i, r in rows(stages["mixture"]).items()}
    order = [r.doc_id for r in stages["mixture"].selectExpr("doc_id", "_metadata.file_name f", "_metadata.row_index r").orderBy("f", "r").collect()]
    got, start = {r.doc_id: r for r in stages["token_ids"].collect()}, 0
    assert set(got) == set(order)
    for i in order:
        ids = tok.encode(text[i], add_special_tokens=False).ids + [0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(map(tuple, stages["token_ids"].collect()))


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_awkward_and_empty_tables(spark, name, tmp_path):
    for k, df in enumerate((frame(spark), frame(spark, []))):
        df.write.parquet(f"{tmp_path}/{k}")
        stored = spark.read.parquet(f"{tmp_path}/{k}")
        out = dict(P.STAGES)[name](spark, stored, SF)
        n = out.count()
        assert n <= df.count() and (k == 0 or n == 0)
        if name != "token_ids":
            assert out.columns == list(DOC_COLUMNS)
