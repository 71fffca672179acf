"""Token ids of whole texts, from a file of the tokenizers library.

The pre-tokenizer of a byte-level BPE never joins what stands before a single space with what follows
it, nor what stands on two sides of a single line break; so a text is cut there, and the ids of a text
are the ids of its pieces. Pieces repeat, and each distinct one is encoded once per slice of texts; what a
worker has encoded it keeps, up to `KEPT` pieces. Files with another pre-tokenizer, or with a normalizer,
encode whole texts.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pandas as pd
import pyarrow as pa

from tonearm.llm.texts import U64, Spans, text_slices

#: Pieces that a worker process keeps; when there are more, it starts again.
KEPT = 1_500_000
SLICE_BYTES = 4 << 20
#: Pieces that are encoded as one text.
JOINED = 50_000

_SPACE = np.zeros(256, bool)
_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
#: Bytes that may begin a character of white space, and so give no certain cut.
_DOUBTFUL = _SPACE.copy()
_DOUBTFUL[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_CERTAIN = ~_SPACE
_CERTAIN[0x80:] = False


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where pieces begin: text starts, certain single spaces, and single line breaks and what follows them."""
    n = len(data)
    mark = np.zeros(n + 1, bool)
    if n > 2:
        word_next = ~_DOUBTFUL[data[1:]]
        mark[:-2] |= (data[:-1] == 0x20) & word_next
        single = (data[1:-1] == 0x0A) & _CERTAIN[data[:-2]] & word_next[1:]
        mark[1:-2] |= single
        mark[2:-1] |= single
    mark[offsets] = True
    return np.flatnonzero(mark[:n])


def cuts_hold(config: dict) -> bool:
    """Whether a tokenizer file describes the plain byte-level BPE whose texts can be cut."""
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    pre = config.get("pre_tokenizer") or {}
    return config.get("normalizer") is None and {k: pre.get(k, True) for k in plain} == plain


class Encoder:
    """Encodes texts; made once per worker process and file."""

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.in_pieces = cuts_hold(json.load(file))
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for piece, number in vocabulary.items():
            self.bytes_of[number] = len(piece)  # a byte-level piece has one character for each byte
        self._forget()

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _forget(self) -> None:
        self.keys, self.begin = np.zeros(0, U64), np.zeros(0, np.int64)
        self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, and how many each has.

        Pieces that begin with a space and a word are encoded as one text, whose ids are dealt out by their lengths
        in bytes; the others by themselves.
        """
        spaced = np.array([len(p) > 1 and p[0] == 0x20 and not _DOUBTFUL[p[1]] for p in pieces], bool)
        size = np.zeros(len(pieces), np.int64)
        parts = [np.zeros(0, np.uint32)]
        order = np.concatenate([np.flatnonzero(spaced), np.flatnonzero(~spaced)])
        together = order[: spaced.sum()]
        for at in range(0, len(together), JOINED):
            own = [pieces[i] for i in together[at : at + JOINED].tolist()]
            ids = self.tokenizer.encode_batch_fast([b"".join(own).decode()], add_special_tokens=False)[0].ids
            ids = np.array(ids, np.uint32)
            ends = np.cumsum([len(p) for p in own])
            last = np.searchsorted(np.cumsum(self.bytes_of[ids]), ends) + 1
            size[together[at : at + JOINED]] = np.diff(last, prepend=0)
            parts.append(ids)
        alone = order[spaced.sum() :]
        found = self.tokenizer.encode_batch_fast([pieces[i].decode() for i in alone.tolist()], add_special_tokens=False)
        found = [np.array(e.ids, np.uint32) for e in found]
        size[alone] = [len(ids) for ids in found]
        flat = np.concatenate(parts + found)
        begin = np.empty(len(pieces), np.int64)
        begin[order] = np.cumsum(size[order]) - size[order]
        return flat, np.stack([begin, size])

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        flat, (begin, size) = self._ids(pieces)
        keys = np.concatenate([self.keys, keys])
        begin = np.concatenate([self.begin, begin + len(self.ids)])
        size = np.concatenate([self.size, size])
        order = np.argsort(keys)
        self.keys, self.begin, self.size = keys[order], begin[order], size[order]
        self.ids = np.concatenate([self.ids, flat])

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, each text's followed by `end_id`, and the bounds of each text's."""
        if not self.in_pieces:
            own = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])]
            found = [e.ids + [end_id] for e in self.tokenizer.encode_batch_fast(own, add_special_tokens=False)]
            bounds = np.concatenate([[0], np.cumsum([len(ids) for ids in found])]).astype(np.int64)
            return np.array([i for ids in found for i in ids], np.uint32), bounds
        begin = cuts(data, offsets)
        stop = np.append(begin[1:], len(data))
        code, keys = pd.factorize(Spans(data).hash(begin, stop))
        if len(self.keys) + len(keys) > KEPT:
            self._forget()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        if not known.all():
            seen = np.zeros(len(keys), np.int64)
            seen[code] = np.arange(len(code))
            raw, new = data.tobytes(), np.flatnonzero(~known)
            pieces = [raw[a:b] for a, b in zip(begin[seen[new]].tolist(), stop[seen[new]].tolist())]
            self._learn(keys[new], pieces)
            at = np.searchsorted(self.keys, keys)
        size, source = self.size[at][code], self.begin[at][code]
        first = np.searchsorted(begin, offsets)
        texts = len(offsets) - 1
        # Where each piece's ids go: behind those of the pieces before it and the end ids of the texts before.
        before = np.cumsum(size) - size
        text = np.repeat(np.arange(texts), np.diff(first))
        out = np.full(int(size.sum()) + texts, end_id, np.uint32)
        inner = np.arange(int(size.sum())) - np.repeat(before, size)
        out[np.repeat(before + text, size) + inner] = self.ids[np.repeat(source, size) + inner]
        return out, np.append(before, size.sum())[first] + np.arange(texts + 1)


def largest_id(path: str, end_id: int) -> int:
    """The largest id that texts of this tokenizer file can have."""
    return max(len(Encoder.of(path).bytes_of) - 1, end_id)


def encoded(texts: pa.Array, path: str, end_id: int):
    """(first row, row behind the last, ids, bounds) of each slice of a text column."""
    encoder = Encoder.of(path)
    for first, last, data, offsets in text_slices(texts, SLICE_BYTES):
        yield first, last, *encoder.encode(data, offsets, end_id)
