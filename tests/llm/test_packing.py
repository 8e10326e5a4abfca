import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm.helpers import empty, messy

from fieldlight.llm import packing

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.tokenizer_path())


def test_ids_are_the_tokenizers(tokenizer):
    texts = ["It's I'LL they've don't_x 12 a1b2", "ÜBER straße été Ø × ÷", "ＡＢΣ Σίσυφος ΣΑΣ İ", "a\x1cb <|endoftext|>x<|startoftext|> <|", "", None, " \t ", "²³½ 漢字 \U0001f600 a b　c\x85d é", "!!?--''s 's", "x" * 3000, "�"]
    ids, n = packing.token_ids(pa.array(texts), packing.tokenizer_path())
    got = np.split(ids, np.cumsum(n)[:-1])
    assert [g.tolist() for g in got] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_other_tokenizers_are_used_as_they_are():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    other, texts = Tokenizer.from_file(path), ["It's  I'LL\n\n they've", "ÜBER straße", "", None, " a b "]
    for kind in (pa.string(), pa.binary()):
        ids, n = packing.token_ids(pa.array([t if t is None or kind == pa.string() else t.encode() for t in texts], kind), path)
        assert [g.tolist() for g in np.split(ids, np.cumsum(n)[:-1])] == [other.encode(t or "", add_special_tokens=False).ids for t in texts]
    packing.token_ids(pa.array(texts), packing.tokenizer_path())
    assert not packing._ids[path].by_words and packing._ids[packing.tokenizer_path()].by_words


def check(docs, pieces, tokenizer, window):
    want = {}
    for d, t in docs:
        want.setdefault(d, []).append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1])
    by_doc, by_sequence = {}, {}
    for r in pieces:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0 and r.offset + r.length <= window
        by_doc.setdefault(r.doc_id, []).append((r.sequence_id * window + r.offset, r.start, r.doc_tokens, ids))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert by_doc.keys() == want.keys()
    for d, parts in by_doc.items():
        whole, docs_of = [], []
        for _, start, total, ids in sorted(parts):
            assert start == len(whole)
            whole += ids
            if len(whole) == total:
                docs_of.append(whole)
                whole = []
        assert not whole and sorted(docs_of) == sorted(want[d])
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s, parts in by_sequence.items():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == window or s == len(by_sequence) - 1


@pytest.mark.parametrize("window", [16, 2048])
def test_messy(spark, tokenizer, window):
    df = messy(spark).repartition(5)
    check([(r.doc_id, r.text) for r in df.collect()], packing.pack(df, window=window).collect(), tokenizer, window)
    assert packing.pack(empty(spark)).collect() == []


def test_query(spark, sf_dir):
    crc = {(r.doc_id, r.start): r.ids_crc32 for r in packing.op7_packing(spark, sf_dir).collect()}
    pieces = packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    assert all(crc[r.doc_id, r.start] == zlib.crc32(r.ids) for r in pieces)
