"""Token ids of whole texts by public tokenizers, with a cache of pieces.

A text is cut before every run of white space.  Neither tokenizer lets a token
run from another character into white space, so the ids of a text are the ids
of its pieces end to end.  Pieces are hashed in one pass over a batch, distinct
ones are looked up in sorted arrays, and missing ones are encoded in one call.
A text with rare characters, which could be white space or change when they
are encoded, is encoded as a whole; so is a very long piece.

``WordCacheEncoder`` reads a byte-level BPE (tokenizers library), ``PieceEncoder``
a model of the sentencepiece library, which puts a space before the text.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from .common import hash_spans

#: Pieces kept in a worker's cache (results do not depend on it).
CACHE_PIECES = 500_000
#: Bytes of a piece that is encoded on its own.
LONG = 4096

#: The byte pattern that cuts text before the merges of byte-level BPE, and the bytes that its alphabet spells as
#: themselves (fixed values of this kind of vocabulary).
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PLAIN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    rest = [b for b in range(256) if b not in _PLAIN_BYTES]
    return {chr(b): b for b in _PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(rest)}


class CachedEncoder:
    """Ids of texts by a tokenizer; sub-classes say how."""

    #: Bytes that begin a piece.
    lead = b" "
    #: A text with one of these characters is encoded as a whole.
    rare: re.Pattern
    #: Bytes of each id.
    id_bytes: np.ndarray
    #: What the tokenizer sees before every text.
    prefix = b""

    def __init__(self):
        self._is_lead = np.zeros(256, bool)
        self._is_lead[list(self.lead)] = True
        self._forget()

    def _forget(self) -> None:
        self._hashes, self._at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._n = np.zeros(0, np.int64)
        self._ids, self._held = np.zeros(1 << 16, np.uint32), 0

    def whole(self, text: str) -> list[int]:
        """Ids of a text, without any cut; ``prefix`` is not part of ``text``."""
        raise NotImplementedError

    def pieces(self, run: str) -> list[int]:
        """Ids of pieces end to end, each with its white space."""
        raise NotImplementedError

    def piece(self, piece: str) -> list[int]:
        """Ids of one piece."""
        raise NotImplementedError

    def _add(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> None:
        """Encode new pieces (distinct, rising hashes) and remember them."""
        led = self._is_lead[data[starts]] & ~self._is_lead[data[ends - 1]] & (ends - starts <= LONG)
        joint, single = np.flatnonzero(led), np.flatnonzero(~led)
        ids = np.zeros(0, np.uint32)
        counts, at = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        if len(joint):
            size = ends[joint] - starts[joint]
            begin = np.cumsum(size) - size
            run = data[np.repeat(starts[joint] - begin, size) + np.arange(int(size.sum()))]
            ids = np.array(self.pieces(run.tobytes().decode()), np.uint32)
            cut = np.searchsorted(np.cumsum(self.id_bytes[ids]), begin + size) + 1
            counts[joint] = np.diff(cut, prepend=0)
            at[joint] = cut - counts[joint]
        alone = [np.array(self.piece(data[starts[i]:ends[i]].tobytes().decode()), np.uint32) for i in single]
        counts[single] = [len(x) for x in alone]
        at[single] = len(ids) + np.cumsum(counts[single]) - counts[single]
        ids = np.concatenate([ids, *alone])
        if self._held + len(ids) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros(max(len(self._ids), len(ids)), np.uint32)])
        self._ids[self._held:self._held + len(ids)] = ids
        at += self._held
        self._held += len(ids)
        place = np.searchsorted(self._hashes, hashes)
        self._hashes = np.insert(self._hashes, place, hashes)
        self._at, self._n = np.insert(self._at, place, at), np.insert(self._n, place, counts)

    def encode_flat(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, ids per text); a null or empty text has none."""
        odd = {i for i, t in enumerate(texts) if t and self.rare.search(t)}
        plain = [i for i, t in enumerate(texts) if t and i not in odd]
        parts = {i: np.array(self.whole(texts[i]), np.uint32) for i in odd}
        n = np.zeros(len(texts), np.int64)
        n[list(parts)] = [len(x) for x in parts.values()]
        flat, counts = self._encode_plain([texts[i] for i in plain])
        n[plain] = counts
        if not parts:
            return flat, n
        out = np.empty(int(n.sum()), np.uint32)
        begin = np.cumsum(n) - n
        mask = np.ones(len(out), bool)
        for i, ids in parts.items():
            out[begin[i]:begin[i] + n[i]] = ids
            mask[begin[i]:begin[i] + n[i]] = False
        out[mask] = flat
        return out, n

    def _encode_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        raw = [self.prefix + t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in raw])])
        lead = self._is_lead[data]
        first = lead.copy()
        first[1:] &= ~lead[:-1]
        first[offsets[:-1]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(data))
        hashes, at, back = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        if len(self._hashes) > CACHE_PIECES:
            self._forget()
        place = np.searchsorted(self._hashes, hashes)
        new = np.ones(len(hashes), bool)
        if len(self._hashes):
            new = self._hashes[np.minimum(place, len(self._hashes) - 1)] != hashes
        if new.any():
            self._add(data, starts[at[new]], ends[at[new]], hashes[new])
            place = np.searchsorted(self._hashes, hashes)
        begin, n = self._at[place][back], self._n[place][back]
        before = np.cumsum(n) - n
        flat = self._ids[np.repeat(begin - before, n) + np.arange(int(n.sum()))]
        edges = np.append(before, int(n.sum()))[np.searchsorted(starts, offsets)]
        return flat, np.diff(edges)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; a null text is empty."""
        flat, n = self.encode_flat(texts)
        raw = flat.astype("<u4").tobytes()
        ends = (np.cumsum(n) * 4).tolist()
        return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]


class WordCacheEncoder(CachedEncoder):
    """A byte-level BPE of the tokenizers library."""

    lead = b" \n\t\r"
    #: Other white space, which could join a run, and characters that a library may class otherwise.
    rare = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0ɐ-\U0010ffff]")

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.id_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)  # the vocabulary spells a byte as one character
        self.id_bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self._ranks = self._as_ranks(path)

    @staticmethod
    def _as_ranks(path: str):
        """The same vocabulary as ranks, whose encoder is faster; none if the ids do not rise with the merges."""
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters, vocabulary = byte_alphabet(), model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(vocabulary[a + b] != 256 + i for i, (a, b) in enumerate(pairs)):
            return None
        import tiktoken
        ranks = {bytes(map(letters.__getitem__, t)): i for t, i in vocabulary.items() if i < 256 + len(pairs)}
        return tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    piece = whole

    def pieces(self, run: str) -> list[int]:
        return self._ranks.encode_ordinary(run) if self._ranks else self.whole(run)

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id."""
        letters, out = byte_alphabet(), [b""] * len(self.id_bytes)
        for token, i in self.tokenizer.get_vocab().items():
            out[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        return out


class PieceEncoder(CachedEncoder):
    """A sentencepiece model that puts a space before the text."""

    prefix = b" "
    #: The model's own sign for a space, other white space, and characters that its rules may change.
    rare = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0ɐ-\U0010ffff]")

    def __init__(self, path: str):
        super().__init__()
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        space = "▁"
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self._bytes = [bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace(space, " ").encode()
                       for i, p in enumerate(names)]
        self.id_bytes = np.array([len(b) for b in self._bytes], np.int64)
        self._space = self.model.piece_to_id(space)
        #: Whether some piece goes from another character into a space: then a text is never cut.
        self._joins = any(space in p.lstrip(space) for p in names)
        if self._joins:
            self.rare = re.compile("(?s).")

    def whole(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)

    def pieces(self, run: str) -> list[int]:
        return self.model.encode(run[1:], num_threads=1)  # the model adds the first space

    def piece(self, piece: str) -> list[int]:
        return self.pieces(piece) if len(piece) > 1 else [self._space]

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id."""
        return self._bytes


_loaded: dict[str, CachedEncoder] = {}


def encoder(path: str) -> CachedEncoder:
    """One encoder per worker process."""
    if path not in _loaded:
        _loaded[path] = (PieceEncoder if path.endswith(".model") else WordCacheEncoder)(path)
    return _loaded[path]
