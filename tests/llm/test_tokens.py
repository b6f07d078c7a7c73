"""Packing, sharding, ORC output and token counts against brute force."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dealscope.llm import common, packing, sharding, token_counts, token_orc
from dealscope.llm.tokens import word_encoder

ODD = [
    None, "", " ", "a", "\n\n  \t x", "It's we'll DON'T o'clock 'sd", "Ünïcödé ÀÉ straße ΑΣ İI ﬁ", "<|endoftext|> a <|startoftext|>b",
    "x" * 3000, "a  b   c \n\n d", "日本語 テスト 123 45", "é ́ a b c", "\x1c\x1d a\x85b", "!!--##<|", "🙂👍🏽 ok",
    "word " * 2000, "don''t  <|endoftext|>'s <|endoftext|", "﻿\x00a", "tab\tnew\r\nline ", "1 22 333 ²½ ٣",
]
SCHEMA = "doc_id long, text string, lang string, part int, start long, ids string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, None, 1, 2, "x") for i, t in enumerate(texts)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return {n: Tokenizer.from_file(common.tokenizer_path(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}


def crc(ids):
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())


def test_word_encoder_equals_library(spark, library):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    texts = [t or "" for t in ODD] + [r.text for r in rows]
    ids, offsets = word_encoder(common.tokenizer_path("word_bpe_49k.json")).batch(pa.array(texts, pa.large_string()))
    for i, e in enumerate(library["word_bpe_49k.json"].encode_batch(texts, add_special_tokens=False)):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == e.ids, texts[i][:80]


def test_packing_round_trip(spark, library):
    rows = packing.pack(frame(spark, ODD), window=64).collect()
    whole = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.ids_crc32 == crc(r.ids) and r.length == len(r.ids)
        assert r.start == len(whole.setdefault(r.doc_id, []))
        whole[r.doc_id] += r.ids
        assert r.doc_tokens >= r.start + r.length
    for i, t in enumerate(ODD):
        assert whole[i] == [*library["word_bpe_49k.json"].encode(t or "", add_special_tokens=False).ids, 2]
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert filled.get(r.sequence_id, 0) == r.offset
        filled[r.sequence_id] = r.offset + r.length
    assert all(filled[s] == 64 for s in range(len(filled) - 1)) and filled[len(filled) - 1] <= 64
    seqs = packing.sequences(packing.pack(frame(spark, ODD), window=64), window=64).collect()
    assert all(len(s.input_ids) == 64 for s in seqs) and sum(s.n_tokens for s in seqs) == sum(map(len, whole.values()))


def test_ids_travel_as_bytes(spark):
    """Between its passes packing keeps ids as bytes: the same ids as the list form, for every text."""
    path = common.tokenizer_path("word_bpe_49k.json")
    docs = frame(spark, ODD).coalesce(1)
    lists = {r.doc_id: r.ids for r in packing.encode(docs, path, 2).collect()}
    encoded = packing.encode(docs, path, 2, slice_bytes=50, as_bytes=True)
    assert dict(encoded.dtypes)["ids"] == "binary"
    held = {r.doc_id: memoryview(bytes(r.ids)).cast("i").tolist() for r in encoded.collect()}
    assert held == lists and len(held) == len(ODD)
    pieces = packing.cut(encoded.withColumnRenamed("local_start", "start"), 64, with_ids=True).collect()
    for i, ids in lists.items():
        own = sorted((r.start, r.ids) for r in pieces if r.doc_id == i)
        assert [x for _, part in own for x in part] == ids


def test_packing_empty_table(spark):
    assert packing.pack(frame(spark, ODD).limit(0)).count() == 0


def test_orc_round_trip_and_lookup(spark, library, tmp_dir):
    docs = frame(spark, ODD).union(spark.createDataFrame([(3, "again", None, 1, 1, "x"), (None, "no id", None, 1, 1, "x")], SCHEMA))
    token_orc.write(docs, tmp_dir + "/orc")
    rows = token_orc.checksums(token_orc.read(spark, tmp_dir + "/orc")).collect()
    rows.sort(key=lambda r: r.start)
    enc = library["word_bpe_49k.json"]
    want, at = [], 0
    for d, t in [(None, "no id"), *[(i, t) for i, t in enumerate(ODD[:4])], (3, "again"), *[(i + 4, t) for i, t in enumerate(ODD[4:])]]:
        ids = [*enc.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((d, at, len(ids), crc(ids)))
        at += len(ids)
    assert [tuple(r) for r in rows] == want
    assert [r.doc_id for r in token_orc.lookup(spark, tmp_dir + "/orc", [5]).collect()] == [5]
    from pyarrow import orc
    import glob
    assert orc.ORCFile(sorted(glob.glob(tmp_dir + "/orc/*.orc"))[0]).nstripes >= 0


def test_sharding_law(spark):
    texts = [None, "", "é", *["t" * (7 * i % 50) for i in range(400)], "same", "same"]
    rows = sharding.shard(frame(spark, texts), shards=7).collect()
    rows.sort(key=lambda r: r.doc_id)
    sizes = [len((t or "").encode()) + 8 for t in texts]
    total, before, seen = sum(sizes), 0, {}
    for r, size, t in zip(rows, sizes, texts, strict=True):
        assert (r.size, r.text_crc32, r.start) == (size, zlib.crc32((t or "").encode()), before)
        assert r.shard == (2 * before + size) * 7 // (2 * total)
        assert r.slot == seen.get(r.shard, 0)
        seen[r.shard] = r.slot + 1
        before += size
    by = [sum(r.size for r in rows if r.shard == s) for s in range(7)]
    assert max(by) - min(by) <= 2 * max(sizes)
    assert sharding.shard(frame(spark, texts).limit(0)).count() == 0


def test_sharding_writes_every_row(spark, tmp_dir):
    sharding.write_shards(frame(spark, ["a", "bb", "ccc", None]), tmp_dir + "/s", shards=2)
    assert spark.read.parquet(tmp_dir + "/s").count() == 4


def test_token_counts_equal_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = ODD + [r.text for r in docs.collect()]
    got = {r.doc_id: r for r in token_counts.token_counts(frame(spark, texts)).collect()}
    for i, e in enumerate(library["byte_bpe_50k.json"].encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert (got[i].n_tokens, got[i].n_bytes) == (len(e.ids), len((texts[i] or "").encode())), (texts[i] or "")[:80]
        assert got[i].over_limit == (len(e.ids) > 512)
    assert token_counts.token_counts(frame(spark, texts).limit(0)).count() == 0


def test_every_prefix_is_exact(spark, library):
    enc, c = library["byte_bpe_50k.json"], token_counts.counter(common.tokenizer_path("byte_bpe_50k.json"))
    for t in ["It's  the   antidisestablishment\n\n of 12345!!! we'll", "a <|endoftext|> b<|endof", "éàü straße  x", "Unglaublichkeitschung des"]:
        ends, counts = c.boundaries(t)
        for k in range(len(t) + 1):
            assert c.prefix_count(t, ends, counts, k) == len(enc.encode(t[:k], add_special_tokens=False).ids), (t, k)
    word = "antidisestablishmentarianism"
    assert c.table(word.encode()) == [len(enc.encode(word[:k]).ids) for k in range(len(word) + 1)]


def test_truncation_from_stored_tables(spark, library):
    docs = frame(spark, ODD)
    cut = token_counts.truncate_to(docs, token_counts.prefix_tables(docs), 5)
    assert cut.count() == len(ODD)
    for r in cut.where(F.col("text").isNotNull()).collect():
        assert (ODD[r.doc_id] or "").startswith(r.text)
        assert len(library["byte_bpe_50k.json"].encode(r.text, add_special_tokens=False).ids) <= 5


def test_truncation_and_shards_keep_every_row(spark, library, tmp_dir):
    """Null and repeated ids, repeated rows, columns named like the operators' own."""
    enc = library["byte_bpe_50k.json"]
    rows = [(None, "one two three four five six", 1, "a"), (7, "x" * 50, 2, "b"), (7, "y z", 3, "c"), (7, "y z", 4, "d"),
            (None, None, 5, "e"), (8, "", 6, "f"), (9, "don't  stop\n\n now", 7, "g"), (10, "a<|endoftext|>b", 8, "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, counts int, shard string").repartition(3)
    for budget in (0, 1, 2, 5, 100):
        cut = {r.counts: r for r in token_counts.truncate_to(docs, token_counts.prefix_tables(docs), budget).collect()}
        assert len(cut) == len(rows)
        for doc_id, text, n, shard in rows:
            r, text = cut[n], text or ""
            assert (r.doc_id, r.shard) == (doc_id, shard) and text.startswith(r.text)
            size = lambda t: len(enc.encode(t, add_special_tokens=False).ids)
            assert size(r.text) <= budget
            assert len(r.text) == len(text) or size(text[:len(r.text) + 1]) > budget or "<|" in text
    assert cut[2].text == "x" * 50
    assert 0 < len(token_counts.truncate_to(docs, token_counts.prefix_tables(docs), 2).where("counts = 2").first().text) < 50
    sharding.write_shards(docs, tmp_dir + "/shards", shards=3)
    written = spark.read.parquet(tmp_dir + "/shards").collect()
    assert sorted(r.counts for r in written) == list(range(1, 9))
    for s in {r.shard for r in written}:
        assert sorted(r.slot for r in written if r.shard == s) == list(range(sum(r.shard == s for r in written)))


def test_samples_stay_bounded_where_ids_repeat(spark):
    from dealscope.llm import sampling
    docs = spark.range(20000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    drawn = docs.where(sampling.draw(F.lit(0.2), "text")).count()
    assert 3600 < drawn < 4400
