"""Slices of a batch give the helpers the same texts as the whole batch does."""

import random

import numpy as np
import pyarrow as pa
import pytest

from dealscope.llm import alignment, common, periodic_runs, token_counts
from dealscope.llm.tokens import word_encoder


@pytest.fixture(scope="module")
def batch():
    rng = random.Random(5)
    words = "the of été 中文 straße x, y. z\n 12 don't   b b b b b b b 🤖 <| A".split(" ")
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(40))) for _ in range(600)]
    texts[7], texts[300], texts[301] = None, "", " "
    rows = pa.RecordBatch.from_arrays([pa.array(range(700)), pa.array(["before"] * 100 + texts)], names=["doc_id", "text"])
    return rows.slice(100)  # as Spark may hand it over


def sliced(batch, limit):
    parts = list(common.text_slices(iter([batch]), limit=limit))
    assert sum(p.num_rows for p in parts) == batch.num_rows
    return parts


def test_slices_hold_the_rows_in_order(batch):
    whole = [t or "" for t in batch.column(1).to_pylist()]
    for limit in (1, 500, 1 << 20):
        parts = sliced(batch, limit)
        assert [t for p in parts for t in p.column(1).to_pylist()] == whole
        assert [i for p in parts for i in p.column(0).to_pylist()] == batch.column(0).to_pylist()
        assert len(parts) == 1 if limit == 1 << 20 else len(parts) > 5
    kept = list(common.row_slices(iter([batch]), limit=500))
    assert [t for p in kept for t in p.column(1).to_pylist()] == batch.column(1).to_pylist()
    assert list(common.text_slices(iter([batch.slice(0, 0)]))) == []


def helpers():
    words = word_encoder(common.tokenizer_path("word_bpe_49k.json"))
    counts = token_counts.counter(common.tokenizer_path("byte_bpe_50k.json"))
    pairs = alignment.aligner(common.tokenizer_path("byte_bpe_50k.json"), common.tokenizer_path("piece_bpe_32k.model"))

    def ids(text):
        flat, offsets = words.batch(text, 1)
        return [flat[i:j].tolist() for i, j in zip(offsets, offsets[1:], strict=False)]

    def runs(text):
        n, found, collapsed = periodic_runs._batch(text)
        return list(zip(n.tolist(), map(str, found.to_pylist()), collapsed.to_pylist(), strict=True))

    def aligned(text):
        got = pairs.batch(text)
        return list(zip(np.diff(got.a_at).tolist(), got.groups().tolist(), got.links().tolist(), got.digests(pairs.names), strict=True))

    return {"ids": ids, "counts": lambda t: counts.batch(t).tolist(), "runs": runs, "aligned": aligned}


@pytest.mark.parametrize("name", ["ids", "counts", "runs", "aligned"])
def test_helpers_on_slices(batch, name):
    one = helpers()[name]
    alone = [r for t in batch.column(1).to_pylist() for r in one(pa.array([t or ""], pa.large_string()))]
    for limit in (300, 4000, 1 << 20):
        assert [r for p in sliced(batch, limit) for r in one(p.column(1))] == alone
