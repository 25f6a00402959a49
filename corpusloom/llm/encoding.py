"""Encode whole texts with the tokenizers library, remembering the pieces of a text that come again.

A byte-level vocabulary cuts a text by its pattern before it merges anything, and these cuts can be told from
nearby bytes: before a single space or line feed between two other characters, behind such a line feed, and between
a letter or digit and a mark that ends a word. A text is the sequence of its pieces between such cuts, and equal
pieces have equal ids. All texts of a step are cut in one pass over their bytes, Arrow finds the distinct pieces, a
worker remembers their ids, and the library encodes only pieces that are new. A text with other or repeated white
space is one piece.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

# Pieces whose ids a worker keeps; beyond it starts again, the results don't change. Longer ones, of more bytes than
# this, are not kept: a text with odd white space is one piece, of any size.
MAX_PIECES = 500_000
MAX_KEPT_BYTES = 256
END_ID = 0
# Bytes of text that are cut and looked up at once; a step takes some 40 times as much memory.
STEP_BYTES = 2_000_000
# New pieces that go to the library as one text.
JOINED = 64


def _bytes_in(values: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


_SEPARATOR = _bytes_in(b" \n")
_MARK = _bytes_in(b",.!?;:")
_WORD = _bytes_in(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
# White space that is neither a space nor a line feed, in ASCII; and the first bytes of all other white space.
_ODD = _bytes_in(bytes([9, 11, 12, 13, 28, 29, 30, 31]))
_ODD_LEAD = _bytes_in(bytes([0xC2, 0xE1, 0xE2, 0xE3]))
_LATIN_LEAD, _NO_LATIN_LETTER = 0xC3, (0x97, 0xB7)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str, plain_specials: bool = False, max_pieces: int | None = None, step_bytes: int | None = None, two_ages: bool = False):
        self.max_pieces, self.step_bytes = max_pieces, step_bytes  # None: those of this module
        self.two_ages = two_ages  # pieces that come again outlive max_pieces, twice as many are kept
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = plain_specials
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that begin with a space
        self.opens[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        (self.line_feed,) = self.tokenizer.encode("\n", add_special_tokens=False).ids

    def forget(self) -> None:
        """Give back what the encoder remembers and what Arrow has kept for later use.

        Texts of one task fill the memory of pieces, so the next task loses little; the worker, which outlives it, is small.
        """
        self.known, self.older = {}, {}
        pa.default_memory_pool().release_unused()

    def encode(self, text: str) -> bytes:
        """All ids of ``text``, equal to those of one call of the library."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: Sequence[str]) -> list[bytes]:
        return [data for some in self.each(pa.array(texts, pa.large_string())) for data in some]

    def each(self, texts: pa.Array) -> Iterator[list[bytes]]:
        """Per step of some texts, in order: the ids of every text as bytes."""
        for ids, ends in self.encoded(texts):
            data = memoryview(ids.tobytes())
            yield [bytes(data[4 * a : 4 * b]) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def encoded(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per step of some texts, in order: the ids of all of them and where each text's ids end."""
        for counts, index, starts, table in self._steps(texts):
            n = counts[index]
            total = int(n.sum())
            take = np.repeat(starts[index] - np.cumsum(n) + n, n) + np.arange(total)
            yield table[take], _sums(n)[self._last + 1]

    def counted(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of every text."""
        out = [np.zeros(0, np.int64)]
        for counts, index, _, _ in self._steps(texts):
            out.append(np.diff(_sums(counts[index])[self._last + 1], prepend=0))
        return np.concatenate(out)

    def _steps(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per step: ids per distinct piece, the distinct piece of every piece, where its ids start, all their ids.

        ``_last`` then tells the last piece of every text, that of the text before for an empty one.
        """
        texts = texts.cast(pa.large_binary())
        at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        data = texts.buffers()[2] or pa.py_buffer(b"")
        step_bytes = STEP_BYTES if self.step_bytes is None else self.step_bytes
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(at, at[a] + step_bytes, side="right")) - 1)
            part = data.slice(int(at[a]), int(at[b] - at[a]))
            cuts, odd = _cuts(np.frombuffer(part, np.uint8), at[a : b + 1] - at[a])
            self._last = np.searchsorted(cuts, at[a + 1 : b + 1] - at[a]) - 1
            pieces = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), part])
            found = pieces.dictionary_encode()
            index = found.indices.to_numpy(zero_copy_only=False)
            ids = self._ids(found.dictionary.to_numpy(zero_copy_only=False).tolist(), set(index[np.searchsorted(cuts, odd)].tolist()))
            counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            starts = np.cumsum(counts) - counts
            yield counts, index, starts, np.frombuffer(b"".join(ids), "<u4")
            a = b

    def _ids(self, pieces: list[bytes], odd: set[int]) -> list[bytes]:
        """Ids of distinct pieces; those numbered in ``odd`` are texts with white space that is not a cut."""
        if len(self.known) > (MAX_PIECES if self.max_pieces is None else self.max_pieces):
            self.known, self.older = {}, self.known if self.two_ages else {}
        known, older = self.known, self.older
        found = list(map(known.get, pieces))
        new = [k for k, ids in enumerate(found) if ids is None]
        if older:
            for k in new:
                ids = older.get(pieces[k])
                if ids is not None:
                    found[k] = known[pieces[k]] = ids
            new = [k for k in new if found[k] is None]
        spaced, plain, alone = [], [], []
        for k in new:
            piece = pieces[k]
            (alone if k in odd or piece == b"\n" else spaced if piece[0] == 32 else plain).append(piece)
        known.update(zip(spaced, self._joined(spaced, b"")))
        known.update(zip(plain, self._joined(plain, b"\n")))
        for start in range(0, len(alone), 4096):
            some = alone[start : start + 4096]
            encoded = self.tokenizer.encode_batch_fast([p.decode() for p in some], add_special_tokens=False)
            known.update(zip(some, [np.array(e.ids, "<u4").tobytes() for e in encoded]))
        for k in new:
            found[k] = known[pieces[k]]
            if len(pieces[k]) > MAX_KEPT_BYTES:
                del known[pieces[k]]
        return found

    def _joined(self, words: list[bytes], by: bytes) -> Iterator[bytes]:
        """Ids of words without white space inside, many in one text: behind their space each, or in a line each."""
        for start in range(0, len(words), 64 * JOINED):
            some = words[start : start + 64 * JOINED]
            texts = [(by + by.join(some[k : k + JOINED])).decode() for k in range(0, len(some), JOINED)]
            for encoded in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                ids = np.array(encoded.ids, "<u4")
                data, skip = ids.tobytes(), 4 * len(by)
                cuts = (4 * np.flatnonzero(ids == self.line_feed if by else self.opens[ids])).tolist()
                for a, b in zip(cuts, [*cuts[1:], len(data)]):
                    yield data[a + skip : b]


def _sums(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


def _cuts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of texts that lie between the places ``at`` begin, and the end of the last; then where texts
    begin that stay whole."""
    size = len(data)
    before, after = np.empty_like(data), np.empty_like(data)
    if size:
        before[1:], after[:-1] = data[:-1], data[1:]
        first, last = at[:-1][at[:-1] < at[1:]], at[1:][at[:-1] < at[1:]] - 1
        before[first] = after[last] = 10  # the ends of a text count as white space
    separator, next_separates = _SEPARATOR[data], _SEPARATOR[after]
    odd = separator & (_SEPARATOR[before] | next_separates) | _ODD[data]
    lead = np.flatnonzero(_ODD_LEAD[data])
    if len(lead):
        code = data[lead].astype(np.int64) << 16 | after[lead].astype(np.int64) << 8 | data[np.minimum(lead + 2, size - 1)]
        pair, low = code >> 8, code & 0xFF
        wide = (pair == 0xC285) | (pair == 0xC2A0) | (code == 0xE19A80) | (code == 0xE1A08E) | (code == 0xE2819F) | (code == 0xE38080)
        wide |= (pair == 0xE280) & ((low <= 0x8A) | (low == 0xA8) | (low == 0xA9) | (low == 0xAF))
        odd[lead[wide]] = True
    word = _WORD[before]
    marks = np.flatnonzero(_MARK[data] & next_separates & ~_SEPARATOR[before])
    latin = marks[~word[marks] & (marks >= 2)]
    latin = latin[(data[latin - 2] == _LATIN_LEAD) & ~np.isin(data[latin - 1], _NO_LATIN_LETTER)]
    cut = np.zeros(size + 1, bool)
    cut[:size] = separator
    cut[1:] |= data == 10
    cut[marks[word[marks]]] = True
    cut[latin] = True
    # a text with odd white space is one piece
    whole = np.unique(np.searchsorted(at, np.flatnonzero(odd), side="right") - 1)
    for a, b in zip(at[whole].tolist(), at[whole + 1].tolist()):
        cut[a:b] = False
    cut[at] = True
    cut[size] = True
    return np.flatnonzero(cut).astype(np.int64), at[whole]


@functools.cache
def encoder(path: str, plain_specials: bool = False, max_pieces: int | None = None, step_bytes: int | None = None, two_ages: bool = False) -> Encoder:
    """One encoder a worker process; its memory of pieces lasts from task to task.

    A task has one core, so the library starts no threads, each of which would take memory of its own.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path, plain_specials, max_pieces, step_bytes, two_ages)
