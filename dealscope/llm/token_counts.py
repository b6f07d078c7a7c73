"""Token counts by prefix dynamic programming over a byte-level BPE vocabulary.

``PrefixCounter`` gives the exact token count of *every* byte prefix of a pre-token: the last token of a prefix is
the one suffix token that the merges leave next to the last token of the shorter prefix, so the table of a word
extends the table of any shorter prefix of it.  Pre-tokens are independent, so the count at any prefix of a text is
the count at the last pre-token boundary plus one look into the last word's table; truncation and budget questions
need no re-encoding.

Edge cases: a null text counts like an empty one (0 bytes, 0 tokens); the end-of-text string inside a text is one
token, as in the library; repeated rows are counted per row; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.llm import common

LIMIT = 512
#: The pre-tokenizer pattern and special string of the vocabulary (fixed values).
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
                       r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
SPECIAL = "<|endoftext|>"
#: Chunks of one ASCII word and a mark at most, whose pre-tokens need no pattern search.
WORD = re.compile(r"([A-Za-z]+)([.,;:!?]?)")
REMEMBERED = 400_000

_COUNTERS: dict[str, PrefixCounter] = {}


def byte_of_symbol() -> dict[str, int]:
    """The vocabulary writes printable Latin-1 bytes as themselves and the others as code points from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixCounter:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        symbol = byte_of_symbol()
        to_bytes = lambda s: bytes(symbol[c] for c in s)
        self.ids = {to_bytes(s): i for s, i in model["vocab"].items() if all(c in symbol for c in s)}
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[to_bytes(a), to_bytes(b)] = rank
        self.longest = max(map(len, self.ids))
        self.whole: dict[bytes, bool] = {}
        self.next_to: dict[tuple[bytes, bytes], bool] = {}
        self.totals: dict[str, int] = {}
        self.chunks: dict[str, int] = {}
        self.last = (b"", [0], [b""])

    def encode(self, data: bytes) -> list[bytes]:
        """Plain greedy merging by rank, for the short strings of the compatibility tests."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.merges.get((a, b), 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:],
                                                                                                  strict=False)))
            if rank == 1 << 60:
                break
            a, b = parts[i], parts[i + 1]
            out, k = [], 0
            while k < len(parts):  # every occurrence of the best pair, from the left
                if k + 1 < len(parts) and parts[k] == a and parts[k + 1] == b:
                    out.append(a + b)
                    k += 2
                else:
                    out.append(parts[k])
                    k += 1
            parts = out
        return parts

    def _follows(self, left: bytes, token: bytes) -> bool:
        """Whether merging left + token leaves exactly these two tokens (or the token alone, at the start)."""
        if not left:
            ok = self.whole.get(token)
            if ok is None:
                ok = self.whole[token] = self.encode(token) == [token]
            return ok
        key = (left, token)
        ok = self.next_to.get(key)
        if ok is None:
            if len(self.next_to) > 2_000_000:
                self.next_to.clear()
            ok = self.next_to[key] = self.encode(left + token) == [left, token]
        return ok

    def table(self, word: bytes) -> list[int]:
        """Token counts of all len(word) + 1 byte prefixes of one pre-token."""
        known, counts, lasts = self.last
        shared = len(commonprefix((known, word)))
        counts, lasts = counts[:shared + 1], lasts[:shared + 1]
        ids, follows = self.ids, self._follows
        for end in range(shared + 1, len(word) + 1):
            for begin in range(max(0, end - self.longest), end):
                token = word[begin:end]
                if token in ids and follows(lasts[begin], token):
                    counts.append(counts[begin] + 1)
                    lasts.append(token)
                    break
        self.last = (word, counts, lasts)
        return counts

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens and special strings of a text, in order."""
        if SPECIAL not in text:
            return PIECES.findall(text)
        parts = text.split(SPECIAL)
        out = PIECES.findall(parts[0])
        for part in parts[1:]:
            out.append(SPECIAL)
            out += PIECES.findall(part)
        return out

    def total(self, piece: str) -> int:
        n = self.totals.get(piece)
        if n is None:
            if len(self.totals) >= REMEMBERED:
                self.totals.clear()
            n = self.totals[piece] = 1 if piece == SPECIAL else self.table(piece.encode())[-1]
        return n

    def count(self, text: str) -> int:
        return sum(map(self.total, self.pieces(text)))

    def boundaries(self, text: str) -> tuple[list[int], list[int]]:
        """Code-point ends of the pre-tokens of a text, and the token counts up to them (both begin with 0)."""
        ends, counts = [0], [0]
        for piece in self.pieces(text):
            ends.append(ends[-1] + len(piece))
            counts.append(counts[-1] + self.total(piece))
        return ends, counts

    def prefix_count(self, text: str, ends: list[int], counts: list[int], length: int) -> int:
        """Exact count of text[:length] from the stored boundaries.

        Only the last two pre-tokens before the cut can fall differently in the prefix (a white-space run and the
        word that the cut shortens), so the count starts at the boundary before them.
        """
        at = int(np.searchsorted(ends, length))
        if SPECIAL[0] in text[max(0, length - len(SPECIAL)):length]:
            return self.count(text[:length])  # the cut may lie inside a special string
        back = max(0, at - 3)
        return counts[back] + self.count(text[ends[back]:length])

    def truncate(self, text: str, ends: list[int], counts: list[int], budget: int) -> int:
        """Code points of a longest beginning within ``budget`` tokens: whole pre-tokens, and as much of the next one
        as its table allows."""
        whole = int(np.searchsorted(counts, budget, side="right")) - 1
        at = ends[whole]
        if whole + 1 < len(ends):
            piece = text[at:ends[whole + 1]]
            if piece != SPECIAL:
                left, size = budget - counts[whole], 0
                table = self.table(piece.encode())
                for char in piece:
                    size += len(char.encode())
                    if table[size] > left:
                        break
                    at += 1
                # a cut can split the pre-tokens before it in another way
                while at > ends[whole] and self.prefix_count(text, ends, counts, at) > budget:
                    at -= 1
        return at

    def batch(self, texts: pa.Array) -> np.ndarray:
        """Token counts of many texts.

        Where no two spaces meet, a pre-token never crosses a single space, so such texts are split at spaces and
        dictionary-encoded in Arrow, and every distinct chunk is counted once; the others are counted directly.
        """
        plain = pc.invert(pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, SPECIAL)))
        out = np.zeros(len(texts), np.int64)
        for i in np.flatnonzero(~np.asarray(plain)):
            out[i] = self.count(texts[int(i)].as_py())
        rows = np.flatnonzero(np.asarray(plain))
        if not len(rows):
            return out
        lists = pc.split_pattern(texts.filter(plain), " ")
        chunks = lists.flatten().dictionary_encode()
        names = chunks.dictionary.to_pylist()
        if len(self.chunks) > REMEMBERED:
            self.chunks.clear()
        known = self.chunks
        # neighbours in this order share their tables' beginnings
        for name in sorted(x for x in names if x not in known):
            word = WORD.fullmatch(name)
            if word is None:
                known[name] = self.count(" " + name)
            else:
                known[name] = self.total(" " + word[1]) + (self.total(word[2]) if word[2] else 0)
        each = np.fromiter(map(known.__getitem__, names), np.int64, len(names))
        offsets = np.asarray(lists.offsets, dtype=np.int64)
        offsets = offsets - offsets[0]
        at = chunks.indices.to_numpy(zero_copy_only=False)
        running = np.concatenate(([0], np.cumsum(each[at])))
        first = at[offsets[:-1]]
        bare = np.fromiter((self.count(names[i]) for i in first), np.int64, len(first))
        out[rows] = running[offsets[1:]] - running[offsets[:-1]] - each[first] + bare
        return out


def counter(path: str) -> PrefixCounter:
    """One counter per worker process and vocabulary file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text."""
    path = vocabulary or common.tokenizer_path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.text_slices(batches):
            n = counter(path).batch(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(batch.column(1)).cast(pa.int64()), pa.array(n), pa.array(n > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def prefix_tables(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, text_sha256, ends, counts: the stored prefix table of every text (see ``PrefixCounter.boundaries``).

    Rows of one doc_id, null included, are told apart by the checksum of their text.
    """
    path = vocabulary or common.tokenizer_path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.text_slices(batches):
            tables = [counter(path).boundaries(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([t[0] for t in tables], pa.list_(pa.int32())),
                 pa.array([t[1] for t in tables], pa.list_(pa.int32()))],
                names=["doc_id", "text_sha256", "ends", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       _sha256().alias("text_sha256")) \
        .mapInArrow(run, "doc_id long, text_sha256 string, ends array<int>, counts array<int>")


def _sha256() -> Column:
    return F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)


def truncate_to(docs: DataFrame, tables: DataFrame, budget: int, vocabulary: str | None = None) -> DataFrame:
    """Every document with the beginning of its text that fits ``budget`` tokens, from the stored tables.

    Every row comes out once, whatever its doc_id, with all its columns; a null text becomes ''.  A cut may lie inside
    a pre-token, so a long unbroken run is shortened, not lost.
    """
    path = vocabulary or common.tokenizer_path("byte_bpe_50k.json")
    stored = tables.dropDuplicates(["doc_id", "text_sha256"]).select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"), F.col("ends").alias("__ends"),
        F.col("counts").alias("__counts"))
    joined = docs.withColumn("__own", _sha256()).join(
        stored, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__sha")))
    at, names = docs.columns.index("text"), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.text_slices(batches):
            ends, counts = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("__ends", "__counts"))
            texts = [t[:counter(path).truncate(t, e, c, budget)] for t, e, c in zip(
                batch.column(at).to_pylist(), ends, counts, strict=True)]
            columns = list(batch.columns[:len(names)])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.select(*[F.col(c).cast("string").alias(c) if c == "text" else F.col(c) for c in names],
                         "__ends", "__counts").mapInArrow(run, docs.withColumn("text", F.col("text").cast("string")).schema)
