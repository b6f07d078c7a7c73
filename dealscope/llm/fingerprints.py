"""Document fingerprints: a Merkle tree over spans of words, paragraphs and sections.

A text is cut into paragraphs (lines) and these into sections: a section ends at a blank paragraph, or after a
paragraph whose checksum is a multiple of ``SECTION`` (so that texts without blank lines have sections too, and an
edit moves no cut but its own).  A paragraph's digest covers its bytes, a section's digest its paragraphs' digests,
the root the sections' digests: equal roots mean equal texts, and unequal branches show where two texts differ.
Below a paragraph stand 24-bit checksums of its spans of about ``SPAN`` words, which are cut by content as well: a
span ends after a word whose checksum and its forerunner's say so, within ``SHORTEST`` and ``LONGEST`` words, so an
edit changes only the spans around it.  Runs of more than ``UNBROKEN`` bytes without an ASCII space are cut into words
by code points in the same way.  The likeness of two fingerprints is the Dice coefficient of these multisets, and 1
for equal roots.

A fingerprint is a string ``root:section;section...``, a section ``digest=paragraph,paragraph...`` and a paragraph
``digest.spans`` with the spans in URL-safe base 64, four characters a span.

Edge cases: a null text is an empty one; equal doc_ids are ordered by text; a null doc_id comes last in descending
order; a single document is its own next one; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealscope.llm import common

SPAN = 4
#: Words of a span; with a cut after every third word from the shortest on, spans have SPAN words on average.
SHORTEST, LONGEST, CUT = 2, 16, 3
#: Bytes of a word that is taken as it is; code points of the words that longer ones are cut into.
UNBROKEN = 24
LEAST_POINTS, MOST_POINTS = 3, 12
SECTION = 8
#: Bytes of text in a range of ids.
RANGE_BYTES = 8 << 20
SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def words_of(paragraph: bytes) -> list[bytes]:
    words = paragraph.split(b" ")
    if max(map(len, words)) <= UNBROKEN:
        return words
    out = []
    for word in words:
        if len(word) <= UNBROKEN:
            out.append(word)
            continue
        run, begin, before = word.decode(), 0, 0
        for end, code in enumerate(map(ord, run), 1):
            n = end - begin
            if n >= MOST_POINTS or n >= LEAST_POINTS and ((31 * before + code) * 0x9E3779B1 >> 16) % CUT == 0:
                out.append(run[begin:end].encode())
                begin = end
            before = code
        if begin < len(run):
            out.append(run[begin:].encode())
    return out


def spans(paragraph: bytes) -> list[int]:
    words = words_of(paragraph)
    if len(words) <= SPAN:
        return [zlib.crc32(paragraph) & 0xFFFFFF]
    out, begin, before = [], 0, 0
    for end, own in enumerate(map(zlib.crc32, words), 1):
        n = end - begin
        if n >= LONGEST or n >= SHORTEST and (before + own) % CUT == 0:
            out.append(zlib.crc32(b" ".join(words[begin:end])) & 0xFFFFFF)
            begin = end
        before = own
    if begin < len(words):
        out.append(zlib.crc32(b" ".join(words[begin:])) & 0xFFFFFF)
    return out


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def tree(text: str) -> tuple[str, list[int]]:
    """The fingerprint of a text and its spans' checksums."""
    sections, paragraphs, digests, leaves = [], [], [], []
    top = []

    def close() -> None:
        whole = digest(b"".join(digests))
        top.append(whole)
        sections.append(whole[:6].hex() + "=" + ",".join(paragraphs))
        paragraphs.clear()
        digests.clear()

    for paragraph in text.encode().split(b"\n"):
        own = digest(paragraph)
        found = spans(paragraph)
        leaves += found
        packed = np.array(found, dtype=">u4").view(np.uint8).reshape(-1, 4)[:, 1:].tobytes()
        digests.append(own)
        paragraphs.append(own[:4].hex() + "." + base64.urlsafe_b64encode(packed).decode())
        if not paragraph or own[0] % SECTION == 0:
            close()
    if digests:
        close()
    return digest(b"".join(top)).hex() + ":" + ";".join(sections), leaves


def leaves_of(fingerprint: str) -> list[int]:
    """The spans' checksums of a stored fingerprint."""
    packed = "".join(p.split(".")[1] for s in fingerprint.split(":")[1].split(";") for p in s.split("=")[1].split(","))
    three = np.frombuffer(base64.urlsafe_b64decode(packed), np.uint8).reshape(-1, 3).astype(np.int64)
    return (three[:, 0] << 16 | three[:, 1] << 8 | three[:, 2]).tolist()


def overlap(a: list[int], b: list[int]) -> float:
    return 2 * sum((Counter(a) & Counter(b)).values()) / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints, 0 to 1."""
    return 1.0 if a.split(":")[0] == b.split(":")[0] else overlap(leaves_of(a), leaves_of(b))


def edits(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) of ``b`` whose branches are not in ``a``; only unequal sections are opened."""
    old = [s.split("=") for s in a.split(":")[1].split(";")]
    known, inside = Counter(s for s, _ in old), Counter(p.split(".")[0] for _, ps in old for p in ps.split(","))
    out = []
    for i, (section, paragraphs) in enumerate(s.split("=") for s in b.split(":")[1].split(";")):
        own = [p.split(".")[0] for p in paragraphs.split(",")]
        if known[section] > 0:
            known[section] -= 1
            inside.subtract(own)
            continue
        for k, p in enumerate(own):
            inside[p] -= 1
            if inside[p] < 0:
                out.append((i, k))
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([tree(t)[0] for t in batch.column(1).to_pylist()])],
                names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, fingerprint string")


def edited_text(text: str, following: str) -> str:
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of the text whose last third is replaced by the next document's beginning.

    The next document is the one after it in descending doc_id.  A narrow pass sorts the ids alone and gives the
    bounds of the ranges; then every text goes (compressed) to the task of its range, and the first document of
    each range goes as a guest to the range before it too, so every task sees the follower of its last document.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = int(size // RANGE_BYTES) + 1  # by the size of the texts, not of the ids that are sorted here
    ids = common.materialise(texts.select("doc_id").repartitionByRange(ranges, F.col("doc_id").desc_nulls_last())
                             .withColumn("part", F.spark_partition_id()), "ids")
    tops = ids.groupBy("part").agg(F.max("doc_id").alias("top")).orderBy("part").collect()  # a row per range
    floor = -(1 << 63)
    bounds = np.array([floor if r.top is None else r.top for r in tops], dtype=np.int64)[::-1].copy()
    n = max(1, len(tops))

    def range_of(doc_ids: np.ndarray) -> np.ndarray:
        """0 for the largest ids: the number of ranges whose largest id is below the id's own range."""
        return n - 1 - np.minimum(np.searchsorted(bounds, doc_ids, side="left"), n - 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        heads = set(bounds.tolist())
        for batch in common.text_slices(batches):
            own = [floor if x is None else x for x in batch.column(0).to_pylist()]
            part = range_of(np.array(own, dtype=np.int64)).tolist()
            rows = [(d, p, False, i) for i, (d, p) in enumerate(zip(own, part, strict=True))]
            rows += [(d, (p - 1) % n, True, i) for d, p, _, i in rows if d in heads]
            text = [press.compress(t.encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows]), pa.array([text[r[3]] for r in rows], pa.binary())],
                names=["doc_id", "part", "guest", "text"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        held = None  # part, doc_id, text, fingerprint, spans of the row that waits for its follower
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = [pa.array(list(c), kind) for c, kind in zip(zip(*out, strict=True), (
                pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()),
                strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SCHEMA.split(", ")])

        for batch in batches:
            for doc_id, part, guest, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if guest and (held is None or held[0] != part):
                    continue  # a further copy of the guest's id
                text = unpress.decompress(packed).decode()
                print_, leaves = tree(text)
                if held is not None and held[0] == part:
                    _, before, old, old_print, old_leaves = held
                    new = edited_text(old, text)
                    new_print, new_leaves = tree(new)
                    out.append((None if before == floor else before, len(old),
                                hashlib.sha256(new.encode()).hexdigest(), old_print, new_print,
                                1.0 if new_print == old_print else overlap(old_leaves, new_leaves),
                                1.0 if print_ == old_print else overlap(old_leaves, leaves)))
                held = None if guest else (part, doc_id, text, print_, leaves)
                if len(out) >= 500:
                    yield flush()
        if out:
            yield flush()

    sent = texts.mapInArrow(send, "doc_id long, part int, guest boolean, text binary")
    # equal ids lie in text order; compressed equal texts are equal, so any fixed order of the bytes serves
    laid = sent.repartition(n, "part").sortWithinPartitions("part", "guest", F.col("doc_id").desc(), "text")
    return laid.mapInArrow(compare, SCHEMA)
