"""Benchmark decontamination with DataFrame functions alone.

A benchmark item of L words is looked for in every document's windows of L words; a shorter document is one window.
Similarity counts shingles and ignores their order, so every start is tried at which enough of the window's shingles
are those of some item of L words to reach the bound; at all other starts none can.  A window cut at the document's
begin or end counts where it shares a shingle with the item at the same place of both.  Every such window and every item gets a 64-bit SimHash of its shingles.  The fingerprints lie in
``BLOCKS`` blocks; two fingerprints within ``RADIUS`` bits must agree up to RADIUS // BLOCKS bits in some block, so
an index of each item's blocks with all values that near finds every fingerprint within the radius.  The candidates
are verified exactly: the sum of the smaller over the sum of the larger shingle counts must reach ``percent``.

Edge cases: null and empty texts and documents with fewer words than a shingle match nothing; items that are null
or have fewer words than a shingle are left out, because single words would match clean documents; items with equal
texts are all reported; rows with the same doc_id count as one document; a null doc_id is reported like any other;
an empty table on either side gives no match; other columns are kept by ``decontaminate`` and ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.llm import common

WORDS = 5
PERCENT = 75
BLOCKS = 8
BITS = 64 // BLOCKS
#: Two sets with Jaccard 0.75 have fingerprints 11 bits apart on average, with a standard deviation of 3.
RADIUS = 23
#: A side with at most so many rows of a few longs (25 MB) is broadcast; a larger one is joined by shuffling.
BROADCAST_ROWS = 500_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[\x20\x09-\x0D]+"), "")


def shingle_hashes(words: str, k: int) -> Column:
    """Hashes of all runs of ``k`` words of the array column ``words``, in order."""
    run = ", ".join(f"{words}[i + {j}]" for j in range(k))
    return F.expr(f"if(size({words}) < {k}, cast(array() as array<bigint>), "
                  f"transform(sequence(0, size({words}) - {k}), i -> xxhash64({run})))")


def simhash(hashes: str) -> Column:
    """64-bit SimHash of an array of hashes: bit b is set where more of them have it set than not."""
    return F.expr(f"""aggregate(sequence(0, 63), 0L, (f, b) ->
        if(2 * aggregate({hashes}, 0, (n, h) -> n + cast(getbit(h, b) as int)) > size({hashes}),
           f | shiftleft(1L, b), f))""")


def weighted_similarity(a: str, b: str) -> Column:
    """Sum of the smaller over sum of the larger counts of two arrays of hashes."""
    common_ = (f"aggregate(array_intersect({a}, {b}), 0, (n, s) -> n + "
               f"least(size(filter({a}, x -> x = s)), size(filter({b}, x -> x = s))))")
    return F.expr(f"{common_} / (size({a}) + size({b}) - {common_})")


def bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def items_of(benchmark: DataFrame, k: int) -> DataFrame:
    """item_key (a row number), item_id, item_words, item_hashes, item_print of the items with ``k`` words or more."""
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), words_of(F.col("text")).alias("iw")) \
        .where(F.size("iw") >= k).select("item_id", F.size("iw").alias("item_words"),
                                         shingle_hashes("iw", k).alias("item_hashes")) \
        .withColumn("item_print", simhash("item_hashes")).withColumn("item_key", F.monotonically_increasing_id())


def seed_windows(docs: DataFrame, items: DataFrame, size: int, k: int, percent: int) -> DataFrame:
    """doc_id, start, item_words: the windows in which enough shingles are an item's of that size.

    ``start`` is below 0 for a window cut at the document's begin.  With n shingles in the window and N in the item,
    c common ones reach the bound only if 100 c >= percent (n + N - c).  So the first of them lies at most
    (100 - percent) N / (100 + percent) after the window's begin, and the c-th before its end.
    """
    index = items.select("item_words", F.explode("item_hashes").alias("h")).distinct()
    shingles = docs.select("doc_id", words_of(F.col("text")).alias("w")).select(
        "doc_id", F.greatest(F.size("w") - (k - 1), F.lit(0)).alias("total"), F.posexplode(shingle_hashes("w", k)).alias("i", "h"))
    # rows of one doc_id and size may meet: their positions together can only add windows
    seeds = shingles.join(bounded(index, size), "h").groupBy("doc_id", "total", "item_words") \
        .agg(F.array_sort(F.collect_set("i")).alias("p")).withColumn("n", F.col("item_words") - (k - 1))
    least = f"cast(ceil({percent} * n / 100) as int)"  # in any window, however it is cut
    dense = F.expr(f"filter(sequence(0, size(p) - 1), x -> get(p, x + {least} - 1) - p[x] < n)")
    low = f"if(x = 0, -n, greatest(p[x - 1] + 1, p[x] - cast(floor((100 - {percent}) * n / (100 + {percent})) as int)))"
    need = (f"cast(ceil({percent} * (least(start + n, total) - greatest(start, 0) + n) / (100 + {percent})) as int)")
    return seeds.withColumn("x", F.explode(dense)).withColumn("start", F.explode(F.expr(f"sequence({low}, p[x])"))) \
        .where(F.expr(f"get(p, x + {need} - 1) < start + n")).select("doc_id", "start", "item_words").distinct()


def matches(docs: DataFrame, benchmark: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, item_id, start (word, from 0), n_words, similarity: the best window of every contaminated pair.

    Windows that share a shingle with the item at the same place of both come first; ties go to the earliest window.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = common.materialise(items_of(benchmark, k), "items")
    size = items.agg(F.sum(F.size("item_hashes"))).first()[0] or 0
    windows = common.materialise(seed_windows(texts, items, size, k, percent), "windows")
    # one row per document, so that a text is held and hashed once, however many windows it has
    by_doc = windows.groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(F.struct("start", "item_words")).alias("at"))
    wanted = bounded(by_doc, windows.count())
    hashed = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("id"))) \
        .select("doc_id", "at", words_of(F.col("text")).alias("w")).select("doc_id", "at", shingle_hashes("w", k).alias("all"))
    printed = hashed.select("doc_id", F.size("all").alias("total"), F.explode(F.expr(f"""transform(at, x -> struct(
            x.start as start, x.item_words as item_words,
            slice(all, greatest(x.start, 0) + 1, x.item_words - {k - 1} + least(x.start, 0)) as hashes))""")).alias("x")) \
        .select("doc_id", "total", "x.*").where(F.size("hashes") > 0).withColumn("print", simhash("hashes"))
    blocks = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1)))
    part = f"cast(shiftrightunsigned({{}}, {BITS} * block) & {(1 << BITS) - 1} as int)"
    near = F.expr(f"explode(filter(sequence(0, {(1 << BITS) - 1}), "
                  f"v -> bit_count(v ^ {part.format('item_print')}) <= {RADIUS // BLOCKS}))")
    index = items.select("item_key", "item_words", "item_print", blocks.alias("block")).withColumn("value", near)
    found = printed.withColumn("block", blocks).withColumn("value", F.expr(part.format("print"))) \
        .join(bounded(index, items.count() << BITS), ["item_words", "block", "value"]) \
        .where(f"bit_count(print ^ item_print) <= {RADIUS}") \
        .where(f"not exists(sequence(0, block), b -> b < block and bit_count(shiftrightunsigned(print ^ item_print, "
               f"{BITS} * b) & {(1 << BITS) - 1}) <= {RADIUS // BLOCKS})")  # of several blocks, the first counts
    full = bounded(items.select("item_key", "item_id", "item_hashes"), size)
    aligned = F.expr("exists(zip_with(hashes, slice(item_hashes, 1 - least(start, 0), size(hashes)), (a, b) -> a = b), x -> x)")
    verified = found.join(full, "item_key").withColumn("similarity", weighted_similarity("hashes", "item_hashes")) \
        .where(F.col("similarity") * 100 >= percent).withColumn("aligned", aligned) \
        .where("aligned or size(hashes) in (total, size(item_hashes))")
    begin = F.greatest("start", F.lit(0))
    best = F.max(F.struct("aligned", "similarity", (-begin).alias("back"), "item_words")).alias("best")
    return verified.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("best.back")).cast("long").alias("start"),
        F.col("best.item_words").cast("long").alias("n_words"), F.col("best.similarity").alias("similarity"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents that hold no benchmark passage, with all their columns."""
    hit = common.materialise(matches(docs, benchmark, k, percent).select("doc_id").distinct(), "contaminated")
    return docs.join(bounded(hit, hit.count()), docs["doc_id"].eqNullSafe(hit["doc_id"]), "left_anti")
