"""Token ids of whole texts by a public byte-level BPE vocabulary.

The file of the vocabulary is a parameter.  A text is cut where one plain space
stands between two characters that are not white space, and before and behind a
line feed that does: the vocabulary's own splitting pattern always starts a new
piece there, so the ids of the chunks put together are the ids of the text.
Arrow numbers the distinct chunks of a piece of the texts, only those are looked
up or encoded, and numpy lays their ids out in the order of the texts.  Chunks
recur between pieces too, and each process keeps the ids of those it has met (a
bounded number).  Texts that hold the string of an added token (which becomes
its id) are encoded whole.
"""
from __future__ import annotations

import array
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END = 2
KEPT, KEPT_MARKS, KEPT_CHARS = 400_000, 10_000, 64
PLAIN = re.compile(r"( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?*#$%&|()-]*)")
ODD = re.compile(r"\s\s")
#: white space: bytes that are a character of their own, and longer characters
WHITE = np.array([chr(b).isspace() and b < 0x80 for b in range(256)])
WIDE_WHITE = [c for c in range(0x80, 0x3001) if chr(c).isspace()]


def _byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


BYTE_CHARS = _byte_chars()


def _white(buf: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text are those of white space."""
    flags = WHITE[buf]
    at = np.flatnonzero((buf == 0xC2) | ((buf >= 0xE1) & (buf <= 0xE3)))  # the first bytes of longer white characters
    if len(at):
        a, b, c = (buf[np.minimum(at + k, len(buf) - 1)].astype(np.int32) & 63 for k in range(3))
        wide = buf[at] != 0xC2
        hit = np.isin(np.where(wide, (a & 15) << 12 | b << 6 | c, (a & 31) << 6 | b), WIDE_WHITE)
        flags[at[hit]] = flags[at[hit] + 1] = True
        flags[at[hit & wide] + 2] = True
    return flags


def _cuts(buf: np.ndarray, offs: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Where chunks of the texts ``buf[offs[k]:offs[k + 1]]`` begin or end; the texts ``whole`` are one chunk."""
    white, cut = _white(buf), np.zeros(len(buf) + 1, bool)
    line = buf == 0x0A
    alone = (line | (buf == 0x20))[1:-1] & ~white[:-2] & ~white[2:]
    cut[1:-2] = alone
    cut[2:-1] |= alone & line[1:-1]
    for k in whole:
        cut[offs[k] + 1:offs[k + 1]] = False
    cut[offs] = True
    return np.flatnonzero(cut)


class Encoder:
    def __init__(self, file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.size = self.tokenizer.get_vocab_size()
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array.array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece of the splitting pattern."""
        plain = piece.isascii() and piece.isprintable()  # only the space has another sign
        byte_text = piece.replace(" ", BYTE_CHARS[32]) if plain else piece.encode().decode("latin-1").translate(BYTE_CHARS)
        return array.array("I", [t.id for t in self.model.tokenize(byte_text)]).tobytes()

    def _marks(self, piece: str) -> bytes:
        """Ids of the marks behind a word; few differ."""
        ids = self.marks.get(piece)
        if ids is None:
            ids = self._piece(piece)
            if len(self.marks) < KEPT_MARKS:
                self.marks[piece] = ids
        return ids

    def _chunks(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks.  One Latin word with marks behind it is two pieces at most; others are encoded as they are."""
        out, other = {}, []
        for c in chunks:
            m = PLAIN.fullmatch(c)
            if m:
                word, marks = m.groups()
                out[c] = (self.known.get(word) or self._piece(word)) + self._marks(marks) if marks else self._piece(word)
            else:
                other.append(c)
        out.update(zip(other, self._ids(other)))
        return out

    def encode(self, texts: pa.LargeStringArray) -> list[bytes]:
        """Ids of each text, none of them null, as little-endian unsigned 32-bit integers."""
        offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        lo, hi = int(offs[0]), int(offs[-1])
        if hi - lo < 3:  # no text, or at most one chunk each
            return self._ids(texts.to_pylist())
        buf, offs = np.frombuffer(texts.buffers()[2], np.uint8)[lo:hi], offs - lo
        hold = np.zeros(len(texts), bool)
        for a in self.added:
            hold |= pc.match_substring(texts, a).to_numpy(zero_copy_only=False)
        cuts = _cuts(buf, offs, np.flatnonzero(hold))
        chunks = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(buf)).dictionary_encode()
        names = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, names))
        new = self._chunks([c for c, ids in zip(names, found) if ids is None])
        found = [new[c] if ids is None else ids for c, ids in zip(names, found)]
        if len(self.known) < KEPT:
            self.known.update((c, ids) for c, ids in new.items() if len(c) <= KEPT_CHARS)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, first = np.frombuffer(b"".join(found), "<u4"), sizes.cumsum() - sizes
        which = chunks.indices.to_numpy()
        n = sizes[which]
        ends = np.append(0, n.cumsum())
        ids = flat[np.repeat(first[which] - ends[:-1], n) + np.arange(ends[-1])]
        at = ends[np.searchsorted(cuts, offs)].tolist()
        return [ids[a:b].tobytes() for a, b in zip(at, at[1:])]


@lru_cache(maxsize=2)
def encoder(file: str) -> Encoder:
    return Encoder(file)


def encoded(texts: pa.Array | Iterable[str | None], file: str = VOCABULARY, piece: int = 1 << 21) -> Iterator[bytes]:
    """Ids of each text (null: of the empty text), worked on in pieces of about
    ``piece`` bytes or one longer text, so that only a piece is in memory at a time."""
    texts = texts if isinstance(texts, pa.Array) else pa.array(list(texts), pa.string())
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    enc, lo = encoder(file), 0
    ends = pc.cumulative_sum(pc.binary_length(texts)).to_numpy()
    while lo < len(texts):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + piece, side="right")))
        yield from enc.encode(texts.slice(lo, hi - lo))
        lo = hi
