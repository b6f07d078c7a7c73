"""Token ids of the lower-casing word BPE vocabulary, exactly as the tokenizers library gives them.

White space never enters a token of this vocabulary, so a text's ids are the ids of its white-space separated
chunks in order.  A batch of texts is split and dictionary-encoded in Arrow, each distinct chunk is encoded once,
and the ids are gathered back: the library sees every distinct chunk of a batch once, not every occurrence.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The pre-tokenizer pattern of the vocabulary file, for the lower case of PRINTABLE (fixed value).
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
#: Printable ASCII and the precomposed letters of Latin-1: normalisation changes nothing but the case here.
PRINTABLE = re.compile(r"[!-~À-ÖØ-öø-ÿ]*")
#: How the vocabulary writes the bytes 33 to 255 that occur in PRINTABLE's UTF-8 form (128 to 191 and 195).
SYMBOLS = {b: chr(b) for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
SYMBOLS |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in SYMBOLS)}
#: Chunks whose ids a worker remembers in each of two generations: when the young one is full, it becomes the old.
REMEMBERED = 120_000

_ENCODERS: dict[str, WordEncoder] = {}


class WordEncoder:
    """Ids are kept as the bytes of little-endian 32-bit integers: small, and joined without Python integers."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        symbols = piece if piece.isascii() else "".join(map(SYMBOLS.__getitem__, piece.encode()))
        return array("i", [t.id for t in self.model.tokenize(symbols)]).tobytes()

    def _printable(self, chunk: str) -> bytes:
        pieces = PIECES.findall(chunk.lower())
        return self._piece(pieces[0]) if len(pieces) == 1 else b"".join(map(self._known, pieces))

    def _known(self, piece: str) -> bytes:
        ids = self.young.get(piece) or self.old.get(piece)
        if ids is None:
            ids = self.young[piece] = self._piece(piece)
        return ids

    def chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks without white space."""
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        out = [young.get(c) for c in chunks]
        rest = []
        for i in [i for i, ids in enumerate(out) if ids is None]:
            chunk = chunks[i]
            ids = old.get(chunk)
            if ids is None:
                if not PRINTABLE.fullmatch(chunk) or "<|" in chunk:
                    rest.append(i)
                    continue
                ids = self._printable(chunk)
            out[i] = young[chunk] = ids
        for i, e in zip(rest, self.library.encode_batch_fast([chunks[i] for i in rest], add_special_tokens=False),
                        strict=True):
            out[i] = young[chunks[i]] = array("i", e.ids).tobytes()
        return out

    def batch(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other (int32), and their n + 1 offsets; ``end_id`` closes every text."""
        if not pc.any(pc.match_substring(texts, "<|")).as_py():  # else lowering might make a special string
            # fewer distinct chunks: one case, and a comma or full stop after a letter stands alone
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), r"([a-z])([.,])([ \n]|$)", r"\1 \2\3")
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        each = self.chunks(words.dictionary.to_pylist())
        sizes = np.fromiter(map(len, each), np.int32, len(each)) // 4
        ids = np.frombuffer(b"".join(each), "<i4")
        begin = np.cumsum(sizes, dtype=np.int32) - sizes
        at = words.indices.to_numpy(zero_copy_only=False)
        n = sizes[at]
        done = np.cumsum(n, dtype=np.int32)
        place = np.repeat(begin[at] - (done - n), n)
        place += np.arange(len(place), dtype=np.int32)
        flat = ids[place]
        word_offsets = np.asarray(lists.offsets, dtype=np.int64)
        offsets = np.concatenate(([0], done)).astype(np.int64)[word_offsets - word_offsets[0]]
        if end_id is not None:
            offsets = offsets + np.arange(len(offsets))
            closed = np.empty(len(flat) + len(offsets) - 1, np.int32)
            own = np.ones(len(closed), bool)
            own[offsets[1:] - 1] = False
            closed[own], closed[~own] = flat, end_id
            flat = closed
        return flat, offsets


def word_encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
