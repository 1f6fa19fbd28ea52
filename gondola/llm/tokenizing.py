"""Token ids of whole texts with a public byte-level BPE vocabulary, as packed unsigned 16-bit integers.

The pre-tokeniser never lets a piece reach across a single space between two characters that
aren't white space, so a text is cut there and each chunk's ids are looked up in a bounded
per-worker cache. Texts for which that does not hold go to the encoder whole. BlockEncoder does
this for many texts at once: Arrow cuts them and finds their distinct chunks, those that aren't
known are encoded in one call, and the ids are put together by index.
"""

from __future__ import annotations

import base64
import importlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "byte_bpe_50k.tiktoken"
END_OF_TEXT = ("<|endoftext|>", 50256)
#: Chunks kept by a worker's cache (about 160 bytes each, 25 in a BlockEncoder); when it is full, those not used since it was half as full go.
CACHE_CHUNKS = 2_000_000

#: White space as str.isspace has it, and texts that can't be cut at single spaces (or hold the special token).
_WHITE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_WHOLE = rf"^ |{_WHITE} | {_WHITE}|{_WHITE}$|<\|endoftext\|>"


def vocabulary_path(name: str = VOCABULARY) -> str:
    return importlib.import_module("public_tokenizers").path(name)


class _Uncut(Exception):
    """A chunk starts or ends with white space: this text can't be cut at single spaces."""


class _ChunkIds(dict):
    """Chunk (without the space before it) -> ids; misses are encoded."""

    def __init__(self, encoder, encode):
        super().__init__()
        self.encoder, self.encode, self.before = encoder, encode, {}
        self.stops = {c: array("H", encoder._encode_single_piece(c)).tobytes() for c in ",."}

    def age(self) -> None:
        """Keep what is held for one more turn only, unless it is used."""
        self.before = dict(self)
        self.clear()

    def __missing__(self, chunk: str) -> bytes:
        if (ids := self.before.get(chunk)) is not None:
            self[chunk] = ids
            return ids
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Uncut
        if chunk.isalpha():  # one piece: a space and letters
            ids = array("H", self.encoder._encode_single_piece(" " + chunk)).tobytes()
        elif chunk[:-1].isalpha() and chunk[-1] in ",.":  # that piece and a one-character piece
            ids = self[chunk[:-1]] + self.stops[chunk[-1]]
        else:
            ids = array("H", self.encode(" " + chunk)).tobytes()
        self[chunk] = ids
        return ids


class ChunkEncoder:
    """encode(text) -> bytes of little-endian unsigned 16-bit ids, equal to the whole text's encoding.

    specials: whether a special token's string in a text is that token; else it is ordinary text.
    """

    def __init__(self, path: str | None = None, cache_chunks: int = CACHE_CHUNKS, specials: bool = True):
        import tiktoken

        with open(path or vocabulary_path(), "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        pattern = importlib.import_module("public_tokenizers").PATTERN
        self.encoder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict([END_OF_TEXT]))
        self.ranks = ranks
        self.specials = specials
        self.cache = _ChunkIds(self.encoder, self._encode)
        self.cache_chunks = cache_chunks

    def _encode(self, text: str) -> list[int]:
        if self.specials and END_OF_TEXT[0] in text:
            return self.encoder.encode(text, allowed_special="all")
        return self.encoder.encode_ordinary(text)  # the same, and faster

    def _whole(self, text: str) -> bytes:
        return array("H", self._encode(text)).tobytes()

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id that isn't special."""
        return sorted(self.ranks, key=self.ranks.__getitem__)

    def encode(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        if not first or first[-1].isspace() or not rest:
            return self._whole(text)
        if 2 * len(self.cache) > self.cache_chunks:
            self.cache.age()
        try:
            return self._whole(first) + b"".join(map(self.cache.__getitem__, rest))
        except _Uncut:
            return self._whole(text)


class BlockEncoder:
    """encode(texts, end) -> ids of all texts one after the other, each followed by end, and their bounds; as ChunkEncoder.encode gives them.

    Of the chunks found, cache_chunks are kept with their ids for the next texts (about 25 bytes each).
    """

    def __init__(self, path: str | None = None, cache_chunks: int = CACHE_CHUNKS):
        self.chunks = ChunkEncoder(path)
        self.cache_chunks = cache_chunks
        self.known, self.known_ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.widths = np.zeros(1 << 16, np.int64)
        for k, token in enumerate(self.chunks.token_bytes()):
            self.widths[k] = len(token)

    def _encode_new(self, chunks: pa.Array) -> pa.Array:
        """The ids of each of these chunks, with the space before it."""
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(chunks)], pa.int32()), chunks), pa.scalar(" ", pa.large_string()))[0].as_py()
        ids = self.chunks.encoder.encode_to_numpy(" " + joined, disallowed_special=()) if len(chunks) else np.empty(0, np.uint32)
        ends = np.cumsum(1 + pc.binary_length(chunks).to_numpy())
        at = np.concatenate([[0], np.searchsorted(np.cumsum(self.widths[ids]), ends) + 1])
        return pa.Array.from_buffers(pa.large_binary(), len(chunks), [None, pa.py_buffer(2 * at), pa.py_buffer(ids.astype("<u2"))])

    def encode(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        n = len(texts)
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = pc.match_substring_regex(texts, _WHOLE)
        cut = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        starts = np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy())]).astype(np.int64)
        leads = pc.if_else(whole, texts, pc.list_element(cut, 0)).to_pylist()  # first chunks have no space before them
        old = len(self.known)
        coded = pa.concat_arrays([self.known, cut.flatten()]).dictionary_encode()
        index = coded.indices.to_numpy()[old:].astype(np.int64)
        found, ids = coded.dictionary, pa.concat_arrays([self.known_ids, self._encode_new(coded.dictionary[old:])])
        index[starts[:-1]] = len(found) + np.arange(n)
        order = np.full(len(index) + n, len(found) + n)
        chunk = np.ones(len(order), bool)
        chunk[starts[1:] + np.arange(n)] = False
        order[chunk] = index
        ends = pa.array([*map(self.chunks._whole, leads), end], pa.large_binary())
        joined = pa.concat_arrays([ids, ends]).take(pa.array(order))
        bounds = np.frombuffer(joined.buffers()[1], np.int64)[starts + np.arange(n + 1)] // 2
        if len(found) > self.cache_chunks:  # those that these texts have used stay
            used = np.unique(index[index < len(found)])[: self.cache_chunks]
            found, ids = found.take(pa.array(used)), ids.take(pa.array(used))
        self.known, self.known_ids = found, ids
        return np.frombuffer(joined.buffers()[2], "<u2", bounds[-1]) if bounds[-1] else np.empty(0, "<u2"), bounds


_encoders: dict[tuple, ChunkEncoder | BlockEncoder] = {}


def worker_encoder(path: str | None = None, cache_chunks: int = CACHE_CHUNKS) -> ChunkEncoder:
    """This worker process's encoder, built once for each vocabulary and size of its cache."""
    key = (path, cache_chunks)
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(path, cache_chunks)
    return _encoders[key]


def block_encoder(path: str | None = None, cache_chunks: int = CACHE_CHUNKS) -> BlockEncoder:
    """This worker process's encoder of many texts at once."""
    key = (path, cache_chunks, "block")
    if key not in _encoders:
        _encoders[key] = BlockEncoder(path, cache_chunks)
    return _encoders[key]


def release() -> None:
    """Forget this worker's encoders: workers serve one stage after another, and their caches are large."""
    _encoders.clear()
