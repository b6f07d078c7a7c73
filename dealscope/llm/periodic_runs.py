"""Periodic run detection: stretches of words that repeat with a fixed period, found by recursive frequency splitting.

A run is a maximal stretch of at least ``LEAST_WORDS`` words whose smallest period q fits at least ``LEAST_PERIODS``
times.  Every word of a run then occurs at least ``LEAST_PERIODS`` times inside it, so a word that is rarer than that
within its segment cannot join a run: it splits the segment.  The pieces are counted again until nothing splits; what
survives is lag-scanned.  Splitting and scanning handle all documents of a batch at once: a segment is an entry of an
index array, not a Python object.

The lag scan takes lags by powers of two.  A run of period q in [b, 2b) has at least 4q words, so some multiple x of
b lies in it with 2b equal words at x and x + q; equal blocks have equal hashes, which are doubled from level to level.
Matches are extended word by word, so a hash decides nothing.  A segment of m words costs O(m log m).

Edge cases: a null or empty text, or one of white space only, has no words, no runs and an empty collapsed text; rows
are handled one by one, so repeated rows and null ids come out as often as they came in; an empty table gives no row;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.llm import common

LEAST_WORDS = 6
LEAST_PERIODS = 4
RUN = "struct<start:bigint,length:bigint,period:bigint>"
SCHEMA = f"doc_id bigint, n_words bigint, runs array<{RUN}>, collapsed string"


def split(words: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions that survive the splitting, in order, and the segment of each.

    ``words`` holds a small whole number per word and ``docs`` the document of each word, in order.  Only segments that
    lost a word are counted again.
    """
    width = np.int64(words.max(initial=0)) + 1
    at, segment = np.arange(len(words)), docs.astype(np.int64)
    done_at, done_segment, named = [], [], 0
    while len(at):
        _, kind, counts = np.unique(segment * width + words[at], return_inverse=True, return_counts=True)
        stays = counts[kind] >= LEAST_PERIODS
        touched = np.zeros(int(segment[-1]) + 1, bool)
        touched[segment[~stays]] = True
        still = ~touched[segment]
        if still.any():
            names = np.cumsum(np.diff(segment[still], prepend=segment[still][0]) != 0) + named
            done_at.append(at[still])
            done_segment.append(names)
            named = int(names[-1]) + 1
        left = stays & ~still
        at, segment = at[left], segment[left]
        if not len(at):
            break
        cut = (np.diff(at, prepend=at[0] - 2) != 1) | (np.diff(segment, prepend=segment[0]) != 0)
        segment = np.cumsum(cut) - 1
        enough = np.bincount(segment)[segment] >= LEAST_WORDS
        at, segment = at[enough], segment[enough]
        if len(at):
            segment = np.cumsum(np.diff(segment, prepend=segment[0]) != 0)
    if not done_at:
        return at, segment
    at, segment = np.concatenate(done_at), np.concatenate(done_segment)
    order = np.argsort(at)
    at, segment = at[order], segment[order]
    segment = np.cumsum(np.diff(segment, prepend=segment[0]) != 0)
    enough = np.bincount(segment)[segment] >= LEAST_WORDS
    return at[enough], segment[enough]


def _agree(words: np.ndarray, x: int, lag: int, step: int) -> int:
    """How many words from x on, in direction ``step``, equal the words ``lag`` further right."""
    n, width = 0, 16
    while True:
        if step > 0:
            a, b = words[x + n:x + n + width], words[x + lag + n:x + lag + n + width]
            a = a[:len(b)]
        else:
            low = max(0, x - n - width + 1)
            a, b = words[low:x - n + 1][::-1], words[low + lag:x + lag - n + 1][::-1]
        differ = np.flatnonzero(a != b)
        if len(differ):
            return n + int(differ[0])
        n += len(a)
        if len(a) < width:
            return n
        width *= 4


def lag_scan(words: np.ndarray, at: np.ndarray, segment: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, start as a position in ``words``, sorted by start and period."""
    if not len(at):
        return []
    # all segments one after the other, each closed by a mark that equals nothing else
    _, first = np.unique(segment, return_index=True)
    sizes = np.diff(first, append=len(at))
    place = np.arange(len(at)) + np.repeat(np.arange(len(first)), sizes)
    laid = np.empty(len(at) + len(first), np.int64)
    laid[place] = words[at]
    laid[np.cumsum(sizes + 1) - 1] = -1 - np.arange(len(first))
    origin = np.full(len(laid), -1, np.int64)
    origin[place] = at
    size = np.repeat(sizes, sizes + 1)
    found: dict[tuple[int, int], int] = {}
    with np.errstate(over="ignore"):
        mixed = laid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
        block, b = _doubled(mixed, 1), 1  # block: hashes of the 2b words from each place on
        while True:
            fits = size >= LEAST_PERIODS * b
            if not fits.any():
                break
            laid, origin, size, block = laid[fits], origin[fits], size[fits], block[fits]
            _scan_level(laid, origin, block, b, found)
            block, b = _doubled(block, 2 * b), 2 * b
    return sorted(((start, end - start, period) for (start, end), period in found.items()), key=lambda r: (r[0], r[2]))


def _doubled(block: np.ndarray, width: int) -> np.ndarray:
    out = block * np.uint64(0xBF58476D1CE4E5B9)
    out[:len(block) - width] += block[width:]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0x94D049BB133111EB)
    return out


def _scan_level(words: np.ndarray, origin: np.ndarray, block: np.ndarray, b: int,
                found: dict[tuple[int, int], int]) -> None:
    """Add the runs with a period in [b, 2b); ``found`` maps (start, end) to the smallest period."""
    rows = -(-len(block) // b)
    padded = np.zeros((rows + 1) * b, np.uint64)
    padded[:len(block)] = block
    row, lag = np.nonzero(padded[b:].reshape(rows, b) == padded[:rows * b:b, None])
    x, lag = row * b, lag + b
    inside = x + lag + 2 * b <= len(words)
    x, lag = x[inside], lag[inside]
    if not len(x):
        return
    if found:  # what lies in a known run whose period divides the lag is that run again
        starts = np.array(sorted(found))
        periods = np.array([found[tuple(k)] for k in starts.tolist()])
        run = np.searchsorted(starts[:, 0], origin[x], side="right") - 1
        known = (run >= 0) & (lag % periods[run] == 0) & (origin[x] + lag + 2 * b <= starts[run, 1])
        x, lag = x[~known], lag[~known]
    reach = {}  # how far each lag has been looked at
    for i in np.lexsort((x, lag)).tolist():
        at, q = int(x[i]), int(lag[i])
        if at < reach.get(q, 0):
            continue
        ahead = _agree(words, at, q, 1)
        begin = at - _agree(words, at, q, -1) + 1
        end = at + ahead + q
        reach[q] = at + ahead
        if ahead and end - begin >= max(LEAST_WORDS, LEAST_PERIODS * q):
            key = int(origin[begin]), int(origin[end - 1]) + 1
            found[key] = min(q, found.get(key, q))


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """True for every word that a run contains after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) > 0


def _batch(texts: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """n_words, runs and collapsed text of every text."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    real = np.asarray(pc.greater(pc.binary_length(flat), 0))  # white space at the ends gives empty words
    offsets = np.concatenate(([0], np.cumsum(real)))[offsets]
    flat = flat.filter(pa.array(real))
    words = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n_words = np.diff(offsets)
    at, segment = split(words, np.repeat(np.arange(len(n_words)), n_words))
    found = lag_scan(words, at, segment)
    gone = dropped(len(words), found)
    kept = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum(~gone)))[offsets], pa.int32()), flat.filter(pa.array(~gone)))
    start = np.array([r[0] for r in found], np.int64)
    doc = np.searchsorted(offsets, start, side="right") - 1
    fields = [start - offsets[doc], *(np.array([r[i] for r in found], np.int64) for i in (1, 2))]
    runs = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(doc, np.arange(len(n_words) + 1)).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(f) for f in fields], names=["start", "length", "period"]))
    return n_words, runs, pc.binary_join(kept, pa.scalar(" ", flat.type)).cast(pa.string())


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and collapsed: the text's kept words, joined by one space.

    Words are separated by ASCII white space.  A word is dropped if a run contains it after that run's first period.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.text_slices(batches):
            n_words, runs, collapsed = _batch(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), runs, collapsed],
                                             names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, SCHEMA)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, the latter with a periodic tail in about a tenth of the documents, chosen by their id.

    Let h = crc32(decimal doc_id) and g = floor(h / 10).  If h % 10 = 0, every word from a = g % n on becomes word
    a + (i - a) % p, where p = 1 + floor((n - a) / (3 + g % 8)).  A null doc_id leaves the text as it is.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string"))
    g = F.floor(h / 10)
    text = F.col("text").cast("string")

    def tail(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        bound = F.array(F.struct(w.alias("w"), a.alias("a"), p.alias("p")))
        return F.transform(bound, lambda s: F.array_join(F.transform(
            s.w, lambda x, i: F.when(i < s.a, x).otherwise(F.get(s.w, s.a + (i - s.a) % s.p))), " "))[0]

    words = F.array(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    edited = F.transform(words, lambda w: F.when(F.size(w) > 0, tail(w)))[0]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.when((h % 10 == 0) & (F.length(F.trim(text)) > 0), edited).otherwise(text).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """n_runs, the run of the greatest exact length / period, and checksums of the runs and the collapsed text."""
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, r: F.when(
        r.length * a.period > a.length * r.period, r).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.withColumn("best", F.when(F.size("runs") > 0, best)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
