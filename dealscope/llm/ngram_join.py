"""N-gram Jaccard join: a blocked sparse matrix product of documents by word shingles.

Documents with equal shingle sets form one class, and only classes are compared.

1. One pass makes every text's set of distinct shingles and counts in how many documents each shingle occurs.
   The counts are kept as a table of fixed size (one level per hash cell, the largest of the cell), which only
   fixes an order of all shingles from rare to frequent; any table gives the same result.
2. A second pass takes each class's prefix in that order: two sets with a similarity of at least ``percent`` share
   at least k shingles among their first n - ceil(percent * n / 100) + k, where k is that of the smaller set.  Grouped
   by shingle these give candidate groups; sizes that differ too much separate a group.  The pairs of a small group are
   counted over all shingles, and those with too few are no candidates: unrelated long texts share a shingle or two by
   chance, the more the larger the corpus, and would grow together into one component.  A large group is one star.
3. The candidate groups' components are the blocks of the matrix product.  A block's shingle sets are brought
   together, the product of the block's document-by-shingle incidence with its transpose accumulates the overlaps,
   and overlaps below the bound that the two sizes imply are discarded.  A large component
   is dealt into chunks, and every pair of chunks is a block of its own, so no task holds more than two chunks.  A block returns a spanning forest of its links, not all pairs.
4. The components of the links are the result.

Everything is exact up to collisions of 64-bit hashes.

Edge cases: null and empty texts, and texts of white space alone, have an empty set and are their own component;
with fewer words than a shingle the whole sequence is one; repeated rows have one class; a null doc_id is linked
like any other and never names a component that has another id; an empty table gives no row; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealscope.llm import common
from dealscope.llm.components import components
from dealscope.llm.shingles import WORDS, Shingler, mix, set_key

PERCENT = 75
#: Cells of the frequency table (bytes); a fixed size, so it can be broadcast.
CELL_BITS = 25
#: Bits of the filter of document ids whose sets are needed (fixed size).
FILTER_BITS = 25
#: Shingle entries in a chunk of a block, at most.
BLOCK = 1_000_000
#: A component of n entries is dealt into sqrt(n / UNIT) chunks or more: every set is sent once per chunk, and every
#: pair of chunks is a task of its own, so both the copies and the largest task grow with the root of its size.
UNIT = 4096
#: Classes of a candidate group whose pairs are counted one by one.
GROUP = 8
#: A set of n shingles has n // SHARE more in its prefix, and half as many are asked of a pair (collisions of the
#: shortened hashes may hide a few).
SHARE = 32
#: Shingle entries that the blocks of one round hold, at most, or as many as all sets have.
ROUND = 1 << 28
#: Bytes of text per hash bucket of the two grouping steps.
BUCKET_BYTES = 1 << 25


def _pack(a: np.ndarray) -> bytes:
    """Compress an integer array, byte planes apart."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(b: bytes, dtype: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    k = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(k, -1).T).reshape(-1).view(dtype)


def _ids(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket (the highest ``bits``) and the 32 bits below it."""
    return (hashes >> np.uint64(64 - bits)).astype(np.int64), (hashes >> np.uint64(32 - bits)).astype(np.uint32)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _sets(batch: pa.RecordBatch, shingler: Shingler) -> list[np.ndarray]:
    return shingler.sets([t.encode() for t in batch.column(1).to_pylist()])


def frequencies(texts: DataFrame, words: int, bits: int) -> DataFrame:
    """Two kinds of rows: (doc_id, n, class) of every document, and (bucket, table) of the frequency table."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in common.text_slices(batches):
            sets = _sets(batch, shingler)
            keys = [set_key(s) for s in sets]
            rows = len(sets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(rows, dtype=np.int32) % (1 << bits)), batch.column(0),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.int64()),
                 pa.nulls(rows, pa.binary())], names=["bucket", "doc_id", "n", "class", "blob"])
            every = np.sort(np.concatenate(sets))
            bucket, low = _ids(every, bits)
            cuts = np.searchsorted(bucket, np.arange((1 << bits) + 1))
            full = np.flatnonzero(np.diff(cuts))
            blobs = [_pack(np.diff(low[cuts[b]:cuts[b + 1]], prepend=np.uint32(0))) for b in full.tolist()]
            nothing = pa.nulls(len(full), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), nothing, nothing, nothing,
                                              pa.array(blobs, pa.binary())],
                                             names=["bucket", "doc_id", "n", "class", "blob"])

    def count(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.filter(pc.is_null(table["blob"]))
        blobs = table["blob"].drop_null().to_pylist()
        cells = np.zeros(1 << (CELL_BITS - bits), np.uint8)
        if blobs:
            low = np.sort(np.concatenate([np.cumsum(_unpack(b, "<u4"), dtype=np.uint32) for b in blobs]))
            first = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
            n = np.diff(np.append(first, len(low)))
            level = np.floor(np.log2(n)).astype(np.uint8)
            np.maximum.at(cells, low[first[level > 0]] >> np.uint32(32 - (CELL_BITS - bits)), level[level > 0])
        return pa.table({
            "bucket": pa.array([*[None] * len(rows), key[0].as_py()], pa.int32()),
            "doc_id": pa.concat_arrays([rows["doc_id"].combine_chunks(), pa.nulls(1, pa.int64())]),
            "n": pa.concat_arrays([rows["n"].combine_chunks(), pa.nulls(1, pa.int64())]),
            "class": pa.concat_arrays([rows["class"].combine_chunks(), pa.nulls(1, pa.int64())]),
            "table": pa.array([*[None] * len(rows), zstandard.ZstdCompressor().compress(cells.tobytes())],
                              pa.binary())})

    return texts.mapInArrow(send, "bucket int, doc_id long, n long, class long, blob binary") \
        .groupBy("bucket").applyInArrow(count, "bucket int, doc_id long, n long, class long, table binary")


def frequency_table(counted: DataFrame, bits: int) -> np.ndarray:
    """The whole table, of 2 ** CELL_BITS bytes whatever the corpus."""
    cells = np.zeros((1 << bits, 1 << (CELL_BITS - bits)), np.uint8)
    for r in counted.where("bucket is not null").select("bucket", "table").collect():
        cells[r.bucket] = np.frombuffer(zstandard.ZstdDecompressor().decompress(r.table), np.uint8)
    return cells.reshape(-1)


def prefix_size(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    return np.minimum(n, n - (percent * n + 99) // 100 + 1 + n // SHARE)


def shared_least(n: np.ndarray | int) -> np.ndarray | int:
    """Shingles that the prefixes of two similar sets surely share; n: size of the smaller set."""
    return 1 + n // (2 * SHARE)


def candidate_edges(texts: DataFrame, cells: np.ndarray, words: int, percent: int, bits: int) -> DataFrame:
    """u, v: classes that share enough shingles of both prefixes, or a shingle that many do (as stars around the smallest
    set of each such run)."""
    shared = texts.sparkSession.sparkContext.broadcast(cells)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, levels, seen = Shingler(words), shared.value, set()
        for batch in common.text_slices(batches):
            shingle, owner, size = [], [], []
            for s in _sets(batch, shingler):
                key = set_key(s)
                if not len(s) or key in seen:
                    continue
                seen.add(key)  # one long per distinct text of the task
                level = levels[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                k = prefix_size(len(s), percent)
                rare = s[level == 0]
                first = rare[:k] if len(rare) >= k else s[np.lexsort((s, level))[:k]]
                shingle.append(first)
                owner.append(np.full(len(first), key, np.int64))
                size.append(np.full(len(first), len(s), np.uint32))
            if not shingle:
                continue
            every, owner, size = np.concatenate(shingle), np.concatenate(owner), np.concatenate(size)
            order = np.argsort(every)
            bucket, low = _ids(every[order], bits)
            owner, size = owner[order], size[order]
            cuts = np.searchsorted(bucket, np.arange((1 << bits) + 1))
            full = np.flatnonzero(np.diff(cuts))
            parts = [(cuts[b], cuts[b + 1]) for b in full.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)),
                 pa.array([_pack(np.diff(low[a:b], prepend=np.uint32(0))) for a, b in parts], pa.binary()),
                 pa.array([owner[a:b].tobytes() for a, b in parts], pa.binary()),
                 pa.array([_pack(size[a:b]) for a, b in parts], pa.binary())],
                names=["bucket", "shingles", "owners", "sizes"])

    def link(key: tuple, table: pa.Table) -> pa.Table:
        low = np.concatenate([np.cumsum(_unpack(b, "<u4"), dtype=np.uint32) for b in table["shingles"].to_pylist()])
        owner = np.concatenate([np.frombuffer(b, np.int64) for b in table["owners"].to_pylist()])
        size = np.concatenate([_unpack(b, "<u4") for b in table["sizes"].to_pylist()]).astype(np.int64)
        order = np.argsort(low, kind="stable")
        same = np.concatenate(([False], low[order][1:] == low[order][:-1]))
        order = order[same | np.append(same[1:], False)]  # shingles of one document link nothing
        order = order[np.lexsort((owner[order], size[order], low[order]))]
        low, owner, size = low[order], owner[order], size[order]
        # a class comes once per task that holds a text of it
        once = np.concatenate(([True], (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])))[:len(low)]
        low, owner, size = low[once], owner[once], size[once]
        if not len(low):
            return pa.table({c: pa.array([], pa.int64()) for c in ("u", "v", "least", "hits")})
        # a run ends where the shingle does, or where the next set is too large for all before it
        begins = np.concatenate(([True], (low[1:] != low[:-1]) | (percent * size[1:] > 100 * size[:-1])))
        run = np.cumsum(begins) - 1
        small = np.bincount(run)[run] <= GROUP
        hub = owner[np.flatnonzero(begins)][run]
        stars = np.unique(np.stack([hub, owner], 1)[~small & (hub != owner)], axis=0)
        parts = [(stars[:, 0], stars[:, 1], np.ones(len(stars), np.int64))]
        for step in range(1, GROUP):
            i = np.flatnonzero(small[:-step] & (run[:-step] == run[step:]) &
                               (percent * size[step:] <= 100 * size[:-step]))
            parts.append((owner[i], owner[i + step], shared_least(size[i])))
        u, v, least = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((least, v, u))
        u, v, least = u[order], v[order], least[order]
        new = np.flatnonzero(np.concatenate(([True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])))[:len(u)])
        return pa.table({"u": pa.array(u[new]), "v": pa.array(v[new]), "least": pa.array(least[new]),
                         "hits": pa.array(np.diff(np.append(new, len(u))))})

    return texts.mapInArrow(send, "bucket int, shingles binary, owners binary, sizes binary") \
        .groupBy("bucket").applyInArrow(link, "u long, v long, least long, hits long") \
        .groupBy("u", "v").agg(F.sum("hits").alias("hits"), F.min("least").alias("least")) \
        .where("hits >= least").select("u", "v")


def _plain(ids: pa.Array) -> np.ndarray:
    return np.asarray(ids.fill_null(0), dtype=np.int64)


def _filter_places(ids: np.ndarray) -> np.ndarray:
    h = mix(ids.view(np.uint64))
    return np.stack([h >> np.uint64(64 - FILTER_BITS), (h >> np.uint64(8)) & np.uint64((1 << FILTER_BITS) - 1)]) \
        .astype(np.int64)


def id_filter(ids: DataFrame) -> bytes:
    """A Bloom filter of 2 ** FILTER_BITS bits over a column of longs; it has the same size for any input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            bits[_filter_places(_plain(batch.column(0)))] = True
        packed = zstandard.ZstdCompressor().compress(np.packbits(bits).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], names=["bits"])

    def either(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
        for batch in batches:
            for b in batch.column(0).to_pylist():
                whole |= np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([whole.tobytes()], pa.binary())], names=["bits"])

    row = ids.mapInArrow(run, "bits binary").repartition(1).mapInArrow(either, "bits binary").first()
    return bytes(1 << (FILTER_BITS - 3)) if row is None else bytes(row.bits)


def block_sets(texts: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """members (class, doc_id, ...) with the shingle set (binary, sorted 64-bit) of their document."""
    wanted = texts.sparkSession.sparkContext.broadcast(id_filter(members.select("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, bits = Shingler(words), np.unpackbits(np.frombuffer(wanted.value, np.uint8)).view(bool)
        for batch in batches:
            batch = batch.filter(pa.array(bits[_filter_places(_plain(batch.column(0)))].all(axis=0)))
            for part in common.text_slices(iter([batch])):
                sets = _sets(part, shingler)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([set_key(s) for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], names=["doc_id", "class", "set"])

    sets = texts.mapInArrow(run, "id long, key long, set binary")
    # doc_ids may repeat with other texts, hence the class; a null doc_id is one as well
    return members.join(sets, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("class") == F.col("key"))) \
        .drop("id", "key")


def product_links(owners: list[int], sets: list[np.ndarray], chunk: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among the rows of one block.

    Row a of the product is the count, per row, of the postings of a's shingles.  Rows are sorted by size, and a
    row is only multiplied with the smaller rows that its size allows; in a block of two chunks, only with rows of
    the other chunk.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    order = np.argsort(sizes, kind="stable")
    sizes, sets, chunk = sizes[order], [sets[i] for i in order], chunk[order]
    owners = [owners[i] for i in order]
    entries, row = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    by = np.argsort(entries, kind="stable")  # within a shingle, rows rise
    entries, row = entries[by], row[by]
    new = np.concatenate(([True], entries[1:] != entries[:-1]))
    first = np.flatnonzero(new)
    several = np.diff(np.append(first, len(entries))) > 1  # shingles of one row add to no overlap
    group = np.cumsum(new) - 1
    place = np.empty(len(entries), np.int64)
    place[by] = np.where(several[group], np.arange(len(entries)) - first[group], -1)
    begin = np.empty(len(entries), np.int64)
    begin[by] = first[group]
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    one = chunk.min() == chunk.max()
    for a in range(1, len(sets)):
        span = slice(offsets[a], offsets[a + 1])
        n, at = place[span], begin[span]
        n, at = n[n > 0], at[n > 0]  # smaller rows that hold each shingle
        if not len(n):
            continue
        done = np.cumsum(n)
        hits = row[np.repeat(at - (done - n), n) + np.arange(done[-1])]
        lowest = int(np.searchsorted(sizes, -(-percent * int(sizes[a]) // 100)))
        overlap = np.bincount(hits, minlength=a)[lowest:a]
        union = sizes[a] + sizes[lowest:a] - overlap
        linked = (100 * overlap >= percent * union) & ((chunk[lowest:a] != chunk[a]) | one)
        for b in (np.flatnonzero(linked) + lowest).tolist():
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
                links.append((owners[a], owners[b]))
    return links


def class_links(texts: DataFrame, classes: DataFrame, candidates: DataFrame, words: int, percent: int,
                block: int) -> DataFrame:
    """u, v: linked classes, as spanning forests of the blocks."""
    members = common.materialise(
        components(candidates).withColumnRenamed("node", "class").join(classes, "class"), "members")
    totals = members.groupBy("component").agg(F.sum("n").alias("n"), F.greatest(
        F.ceil(F.sum("n") / F.lit(block)), F.ceil(F.sqrt(F.sum("n") / F.lit(UNIT)))).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    # a class takes part in the block of its chunk with every chunk
    held = common.materialise(block_sets(texts, members.select("class", "doc_id", "component"), words), "sets")
    dealt = held.join(totals, "component").withColumn("chunk", chunk).withColumn("other", other).select(
        "component", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
        "class", "chunk", "set")

    def multiply(key: tuple, table: pa.Table) -> pa.Table:
        _, once = np.unique(np.asarray(table["class"].combine_chunks()), return_index=True)  # rows may be repeated
        table = table.take(pa.array(once))
        sets = [np.frombuffer(b, np.uint64) for b in table["set"].to_pylist()]
        links = product_links(table["class"].to_pylist(), sets, np.asarray(table["chunk"].combine_chunks()), percent)
        return pa.table({"u": pa.array([x[0] for x in links], pa.int64()),
                         "v": pa.array([x[1] for x in links], pa.int64())})

    entries = totals.agg(F.sum("n").alias("held"), F.sum(F.col("n") * F.col("chunks")).alias("sent")).first()
    rounds = max(1, -(-(entries.sent or 0) // max(ROUND, entries.held or 0)))
    of_round = F.pmod(F.xxhash64("component", "i", "j"), F.lit(rounds))
    links = [dealt.where(of_round == k).groupBy("component", "i", "j").applyInArrow(multiply, "u long, v long")
             for k in range(rounds)]
    if rounds > 1:  # a round's copies go before the next one's are made
        links = [common.materialise(x, "links") for x in links]
    return reduce(DataFrame.unionByName, links)


def link(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) of every document."""
    texts = _texts(docs)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = int(min(20, max(4, int(size // BUCKET_BYTES).bit_length())))
    counted = common.materialise(frequencies(texts, words, bits), "frequencies")
    rows = counted.where("bucket is null").select("doc_id", "n", "class")
    classes = rows.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"))
    candidates = candidate_edges(texts, frequency_table(counted, bits), words, percent, bits)
    linked = components(class_links(texts, classes, candidates, words, percent, block))
    named = classes.join(linked.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    names = named.join(least, "component").select("class", "component_id")
    empty = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return rows.where("n > 0").join(names, "class").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(empty)
