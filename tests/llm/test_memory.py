"""Python workers hold a bounded part of a batch at a time."""

import pyarrow as pa
import pytest

import corpus_pipeline
from tessera.llm import bpe
from tessera.llm.common import row_slices


@pytest.fixture(scope="module")
def encoder():
    with open(corpus_pipeline.TOKENIZER, encoding="utf-8") as f:
        return bpe.load(f.read())


def test_rows_are_sliced_by_bytes():
    b = pa.RecordBatch.from_arrays([pa.array(["abc", None, "", "defgh", "ijklmnopqr", "s", "é"])], names=["text"])
    for size in (1, 5, 8, 100):
        parts = list(row_slices(b, "text", size))
        assert [x for p in parts for x in p.column(0).to_pylist()] == b.column(0).to_pylist()
        assert all(p.num_rows == 1 or sum(len((x or "").encode()) for x in p.column(0).to_pylist()) <= size for p in parts)


def test_id_lists_without_tokens(encoder):
    texts = pa.array(["one two  three one", None, "", " \n", "a<unk>b <pad>", "Él niño, 12.5 % – twofold", "one " * 50])
    ids, _, n = encoder.encode_column(texts)
    lists = encoder.id_lists(texts)
    assert [" ".join(map(str, x)) for x in lists.to_pylist()] == [x or "" for x in ids.to_pylist()]
    assert lists.value_lengths().to_pylist() == n.tolist()
    assert encoder.id_lists(texts.slice(1, 2)).to_pylist() == [[], []]


def test_cache_holds_no_whole_batch(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 100)
    b = pa.RecordBatch.from_arrays([pa.array([" ".join(f"w{k}x{i}" for i in range(20)) for k in range(200)])], names=["text"])
    try:
        for part in row_slices(b, "text", 1000):
            encoder.id_lists(part.column(0))
            assert max(len(encoder.cache), len(encoder.older)) <= 500
    finally:
        encoder.cache, encoder.older = {}, {}
