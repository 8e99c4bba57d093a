"""Token ids of texts by the tokenizers library, unit by unit.

A tokenizer first cuts a text into pieces that it encodes one by one.  Where the places
of such cuts are known from the bytes alone, equal units need encoding once: units are
cut and told apart by 64-bit hashes with NumPy, and the library sees every distinct unit of
a chunk that is not in the worker's memory.  That memory is a few arrays sorted by hash, some
40 bytes a unit, and holds no texts.  CUTS says where the known files can be cut:

* before a space that a visible character follows (the space belongs to the next piece);
* at white space, which the tokenizer drops.

Other files are encoded text by text, and so is every text that holds the string of a special
token: the library takes it for that token, and what stands before it is a piece of its own.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from snapfold.llm.words import _BYTE_KEYS, _range_sums, split_words, text_bytes

CUTS = {"byte_bpe_50k.json": "before space", "word_bpe_49k.json": "at white space"}
REMEMBERED = 1_500_000  # units that a worker keeps at most
LOT = 20_000  # units or texts that the library is given at a time

# Bytes that cannot begin white space of any kind: visible ASCII, and lead bytes of
# UTF-8 other than those of U+0080-U+00BF, U+1000-U+1FFF, U+2000-U+2FFF and U+3000-U+3FFF.
_VISIBLE = np.zeros(256, dtype=bool)
_VISIBLE[0x21:0x7F] = True
_VISIBLE[0xC3:0xF5] = True
_VISIBLE[[0xE1, 0xE2, 0xE3]] = False

_encoders: dict[str, Encoder] = {}


@dataclass
class Encoder:
    """One tokenizer file; `encoder` gives the worker's own, which remembers units between tasks."""

    path: str
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint32))
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))  # ascending
    at: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    length: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int32))
    used: int = 0

    def __post_init__(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.cut = CUTS.get(os.path.basename(self.path))
        self.library = Tokenizer.from_file(self.path)
        special = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        # Case is ignored, as a tokenizer may do: a text more that is encoded whole is no fault.
        self.special = re.compile("|".join(special).encode(), re.IGNORECASE) if special else None

    def _library_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after another and how many each has, by the library; in lots, which bounds what it returns."""
        parts, sizes = [np.zeros(0, dtype=np.uint32)], [np.zeros(0, dtype=np.int64)]
        for at in range(0, len(texts), LOT):
            lists = [x.ids for x in self.library.encode_batch_fast(texts[at : at + LOT], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, lists), dtype=np.int64, count=len(lists)))
            parts.append(np.fromiter((i for x in lists for i in x), np.uint32, int(sizes[-1].sum())))
        return np.concatenate(parts), np.concatenate(sizes)

    def _put(self, hashes: np.ndarray, units: list[str]) -> None:
        """Remember units of ascending hashes, none of them known."""
        ids, sizes = self._library_ids(units)
        if self.used + len(ids) > len(self.ids):
            grown = np.zeros(max(self.used + len(ids), len(self.ids) * 3 // 2), dtype=np.uint32)
            grown[: self.used] = self.ids[: self.used]
            self.ids = grown
        self.ids[self.used : self.used + len(ids)] = ids
        where = np.searchsorted(self.hashes, hashes)
        self.at = np.insert(self.at, where, self.used + np.cumsum(sizes) - sizes)
        self.length = np.insert(self.length, where, sizes)
        self.hashes = np.insert(self.hashes, where, hashes)
        self.used += len(ids)

    def _unknown(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.arange(len(hashes))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.flatnonzero(self.hashes[at] != hashes)

    def _units(self, texts: pa.Array):
        """Byte ranges, hashes, and the first unit of each text."""
        if self.cut == "at white space":
            words = split_words(texts)
            return words.data, words.starts, words.ends, words.hashes, words.first
        data, offsets = text_bytes(texts)
        begins = np.zeros(len(data) + 1, dtype=bool)
        begins[:-2] = (data[:-1] == 0x20) & _VISIBLE[data[1:]]
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        begins[-1] = False
        # The last byte of a text and the first of the next are no neighbours.
        last = offsets[1:][np.diff(offsets) > 0] - 1
        single = np.isin(last, offsets[:-1])
        begins[last[~single]] = False
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        return data, starts, ends, _range_sums(_BYTE_KEYS[data], starts, ends), np.searchsorted(starts, offsets)

    def _encode_whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = self._library_ids([x or "" for x in texts.cast(pa.string()).to_pylist()])
        return ids, np.concatenate([[0], np.cumsum(sizes)])

    def _encode_units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, starts, ends, hashes, first = self._units(texts)
        if not len(starts):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(first), dtype=np.int64)
        distinct, sample, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        new = self._unknown(distinct)
        if len(self.hashes) + len(new) > REMEMBERED:
            self.hashes, self.at, self.length, self.used = self.hashes[:0].copy(), self.at[:0].copy(), self.length[:0].copy(), 0
            new = np.arange(len(distinct))
        if len(new):
            raw = data.tobytes()
            spans = zip(starts[sample[new]].tolist(), ends[sample[new]].tolist(), strict=True)
            self._put(distinct[new], [raw[s:e].decode() for s, e in spans])
        slots = np.searchsorted(self.hashes, distinct)[inverse]
        sizes = self.length[slots].astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        where = np.repeat(self.at[slots] - upto[:-1], sizes) + np.arange(upto[-1])
        return self.ids[where], upto[first]

    def _holds_special(self, texts: pa.Array) -> np.ndarray:
        """Which texts hold the string of a special token."""
        data, offsets = text_bytes(texts)
        out = np.zeros(len(offsets) - 1, dtype=bool)
        if self.special is not None and len(data):
            found = [m.start() for m in self.special.finditer(data)]
            # A match over the border of two texts only sends one of them the slow way.
            out[np.searchsorted(offsets, np.array(found, dtype=np.int64), "right") - 1] = True
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the offsets of the texts in them."""
        if self.cut is None:
            return self._encode_whole(texts)
        special = self._holds_special(texts)
        if not special.any():
            return self._encode_units(texts)
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        routes = [(self._encode_whole, special), (self._encode_units, ~special)]
        parts: list[np.ndarray] = [np.zeros(0, dtype=np.uint32)] * len(texts)
        for route, chosen in routes:
            ids, offsets = route(texts.filter(pa.array(chosen)))
            for text, a, b in zip(np.flatnonzero(chosen).tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                parts[text] = ids[a:b]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_documents(texts: pa.Array, path: str, end_id: int) -> list[np.ndarray]:
    """Of each text its ids with the end id, as uint32."""
    ids, offsets = encoder(path).encode(texts)
    ended = np.insert(ids, offsets[1:], end_id)
    at = offsets + np.arange(len(offsets))
    return [ended[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
