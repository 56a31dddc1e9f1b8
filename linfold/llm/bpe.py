"""Byte-level BPE of whole texts with a cache of pieces between spaces.

The pre-tokenizer always starts a new piece where a space follows a character that is no white
space: a run of letters, digits or marks never holds white space, and a run of white space never
starts with another character. So a text is the sum of its pieces cut there, and a piece, which
recurs in very many texts, is encoded once per worker and kept. Texts in which a space follows other
white space, or with white space outside ASCII, are cut or encoded more carefully.
"""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHE_PIECES = 250_000   # in each of two generations
# The white space of the pre-tokenizer beyond the ASCII characters 0x09-0x0D and space
# (and 0x1C-0x1F, which some libraries count as such).
RARE_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
SPACE_RUN = re.compile("[\t\n\r\x0b\x0c ] ")
PIECE = re.compile("[\t\n\r\x0b\x0c ]*[^\t\n\r\x0b\x0c ]+|[\t\n\r\x0b\x0c ]+")
LATIN = re.compile("[\x00-\u024f]*\\Z")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _alphabet() -> dict[str, int]:
    """The public byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for
    the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Pieces(dict):
    """Ids (little-endian unsigned 32-bit) of pieces, each after ``before``; two generations."""

    def __init__(self, encode, before: str):
        super().__init__()
        self.encode, self.before, self.old = encode, before, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = _bytes(self.encode(self.before + piece))
        if len(self) >= CACHE_PIECES:
            self.old = dict(self)
            self.clear()
        if len(piece) < 64:
            self[piece] = ids
        return ids


def plain_byte_level(spec: dict) -> bool:
    """Whether a vocabulary file is byte-level BPE as this module cuts and merges it: no normalizer,
    the public byte-level pre-tokenizer with its own pattern and no added space, and merges in the
    order of the ids they make."""
    before, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if (spec.get("normalizer") is not None or before.get("type") != "ByteLevel" or before.get("add_prefix_space", True)
            or not before.get("use_regex", True) or model.get("type") != "BPE" or model.get("ignore_merges")
            or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")):
        return False
    vocabulary = model["vocab"]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [vocabulary.get(a + b, -1) for a, b in pairs]
    single = [vocabulary.get(c, -1) for c in _alphabet()]
    words = len(single) + len(set(made)) + sum(t["content"] in vocabulary for t in spec.get("added_tokens", []))
    return (min(single) >= 0 and all(x < y for x, y in zip([max(single), *made], made, strict=False))
            and len(vocabulary) == words)


class Encoder:
    """Ids as the tokenizers library gives them, without special tokens added; strings of special
    tokens in a text are these tokens."""

    _made: dict[str, Encoder] = {}

    @classmethod
    def get(cls, path: str) -> Encoder:
        """One encoder per worker and vocabulary."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _alphabet()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        vocabulary = {w: i for w, i in spec["model"]["vocab"].items() if w not in self.special}
        self.token_bytes: dict[int, bytes] = {
            i: bytes(alphabet[c] for c in w) if all(c in alphabet for c in w) else w.encode() for w, i in vocabulary.items()}
        self.token_bytes |= {i: w.encode() for w, i in self.special.items()}
        # Fixed value: the public pattern of this pre-tokenizer.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.known = plain_byte_level(spec)
        plain = {self.token_bytes[i]: i for i in vocabulary.values()}
        self.fast = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=plain,
                                      special_tokens={}) if self.known else None
        self.after_space = _Pieces(self._piece, " ")
        self.at_start = _Pieces(self._piece, "")

    def _piece(self, piece: str) -> list[int]:
        for special in self.special:
            if special in piece:
                break
        else:
            if piece.isascii() or LATIN.match(piece):
                return self.fast.encode_ordinary(piece)   # the same merges, sooner for short texts
        return self.whole.encode(piece, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not self.known or RARE_SPACE.search(text):
            return _bytes(self.whole.encode(text, add_special_tokens=False).ids)
        if SPACE_RUN.search(text):
            return b"".join(map(self.at_start.__getitem__, PIECE.findall(text)))
        first, *rest = text.split(" ")
        return self.at_start[first] + b"".join(map(self.after_space.__getitem__, rest))

    def sizes(self) -> np.ndarray:
        """Bytes of each token."""
        out = np.zeros(max(self.token_bytes) + 1, dtype=np.int64)
        for i, token in self.token_bytes.items():
            out[i] = len(token)
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens included."""
        table = self.token_bytes
        return b"".join([table[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")
