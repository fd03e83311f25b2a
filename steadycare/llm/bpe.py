"""Token ids of whole texts by a byte-level BPE file of the `tokenizers` library, fast on running text.

Byte-level BPE never merges across the borders of its pre-tokens, so equal stretches between safe borders have
equal ids wherever they stand. Texts are cut at such borders; the library encodes each distinct stretch once
and the ids of a text are gathered from a table. Borders are set only where the pre-tokeniser's pattern surely has
one: around a single space or line end between printable characters, and between a letter and ASCII punctuation other
than the apostrophe. Texts that hold an added token's string go to the library whole.
"""

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .flat import Flat, byte_class, flat_slices

KEPT = 600_000  # stretches remembered by a Python worker
LEARNED = 4096  # stretches that the library encodes at once: its results are a hundred times their texts
LEARNED_CHARACTERS = 1 << 17  # and their characters, or one stretch
SLICE = 1 << 18  # bytes of texts taken at once: a slice's arrays are many times its size

_LETTER = byte_class(lambda b: 65 <= b <= 90 or 97 <= b <= 122)
_MARK = byte_class(lambda b: (33 <= b <= 47 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 126) and b != 39)
_PRINTED = byte_class(lambda b: 33 <= b <= 126)
_BREAK = byte_class(lambda b: b in (32, 10))
_ODD_LEAD = byte_class(lambda b: b >= 0xC0 and b != 0xC3)  # may begin a space, a mark or a digit


def borders(flat: Flat) -> np.ndarray:
    """First bytes of the stretches; every text that is not empty begins one."""
    d = flat.data
    size = len(d)
    accented = np.zeros(size, bool)  # last byte of a Latin-1 letter
    accented[1:] = (d[:-1] == 0xC3) & (d[1:] != 0x97) & (d[1:] != 0xB7)
    letter_end = _LETTER[d] | accented
    letter_begin = _LETTER[d] | (d == 0xC3)
    if size:
        letter_begin[:-1] &= ~((d[:-1] == 0xC3) & ((d[1:] == 0x97) | (d[1:] == 0xB7)))
    plain_end, plain_begin = _PRINTED[d] | accented, _PRINTED[d] | letter_begin
    mark, at_break = _MARK[d], _BREAK[d]
    cut = np.zeros(size + 1, bool)
    cut[1:size] = (letter_end[:-1] & mark[1:]) | (mark[:-1] & letter_begin[1:])
    single = np.zeros(size, bool)
    single[1:-1] = at_break[1:-1] & plain_end[:-2] & plain_begin[2:]
    cut[:size] |= single
    line = single & (d == 10)
    cut[1:][line] = True
    cut[flat.at[:-1]] = True
    cut[size] = False
    return np.flatnonzero(cut[:size])


def _portions(stretches: list[str]) -> Iterator[list[str]]:
    """Consecutive stretches, few and short enough for the library to encode at once."""
    first = held = 0
    for i, stretch in enumerate(stretches):
        if i > first and (i - first == LEARNED or held + len(stretch) > LEARNED_CHARACTERS):
            yield stretches[first:i]
            first, held = i, 0
        held += len(stretch)
    if first < len(stretches):
        yield stretches[first:]


class Encoder:
    """Encodes Arrow string arrays; one per Python worker, see `encoder`."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # tasks are the parallelism: threads of the library would keep memory of their own in every worker
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self._keys = np.zeros(0, np.uint64)
        self._entry = np.zeros(0, np.int64)
        self._ids = np.zeros(1 << 16, np.uint32)
        self._bounds = np.zeros(1, np.int64)

    def _learn(self, stretches: list[str]) -> None:
        for part in _portions(stretches):
            self._encode_new(part)

    def _encode_new(self, stretches: list[str]) -> None:
        found = [e.ids for e in self.library.encode_batch_fast(stretches, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        bounds = self._bounds[-1] + np.cumsum(lengths)
        if bounds[-1] > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros(max(len(self._ids), bounds[-1]), np.uint32)])
        self._ids[self._bounds[-1] : bounds[-1]] = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
        self._bounds = np.concatenate([self._bounds, bounds])

    def _entries(self, flat: Flat, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        keys = flat.hashes(starts, ends)
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self._keys) > KEPT:
            self._forget()
        at = np.searchsorted(self._keys, distinct)
        known = at < len(self._keys)
        known[known] = self._keys[at[known]] == distinct[known]
        new = np.flatnonzero(~known)
        entry = np.zeros(len(distinct), np.int64)
        entry[known] = self._entry[at[known]]
        if len(new):
            raw = flat.data.tobytes()
            entry[new] = len(self._bounds) - 1 + np.arange(len(new))
            self._learn([raw[s:e].decode() for s, e in zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
            self._keys = np.insert(self._keys, at[new], distinct[new])
            self._entry = np.insert(self._entry, at[new], entry[new])
        return entry[inverse]

    def _slice(self, flat: Flat, want_ids: bool) -> tuple[np.ndarray, np.ndarray]:
        starts = borders(flat)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(flat.n, np.int64)
        ends = np.append(starts[1:], len(flat.data))
        entry = self._entries(flat, starts, ends)
        lengths = self._bounds[entry + 1] - self._bounds[entry]
        counts = np.bincount(flat.owner(starts), lengths, flat.n).astype(np.int64)
        if not want_ids:
            return np.zeros(0, np.uint32), counts
        shift = self._bounds[entry] - (np.cumsum(lengths) - lengths)
        return self._ids[np.repeat(shift, lengths) + np.arange(lengths.sum())], counts

    def encode(self, texts: pa.Array, want_ids: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, ids of these rows end to end, ids of each row). A null text has none."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        whole = np.zeros(len(texts), bool)
        for token in self.added:
            whole |= pc.fill_null(pc.match_substring(texts, token), False).to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(whole)
        row = 0
        for special in [*edges.tolist(), len(texts)]:
            for a, b, flat in flat_slices(texts.slice(row, special - row), SLICE):
                yield row + a, row + b, *self._slice(flat, want_ids)
            if special < len(texts):
                ids = self.library.encode(texts[special].as_py(), add_special_tokens=False).ids
                yield special, special + 1, np.array(ids, np.uint32), np.array([len(ids)])
            row = special + 1


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))
