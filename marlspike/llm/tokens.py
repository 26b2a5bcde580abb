"""Token ids of whole texts by public vocabularies, with bounded caches per worker.

Texts are cut at places where tokens provably start anew (white space), and the ids of
each piece are kept while the cache has room; a piece that isn't kept is encoded again.
"""

from __future__ import annotations

import base64
import json
import sys
import unicodedata
from array import array

import regex

#: Pieces a cache keeps (some 40 MB).
CACHE_PIECES = 200_000


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder != "little":
        out.byteswap()
    return out.tobytes()


class Cache(dict):
    """piece -> its ids as little-endian 32-bit bytes."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: bytes) -> bytes:
        out = self.encode(piece)
        if len(self) < CACHE_PIECES and len(piece) < 64:
            self[piece] = out
        return out


class WordTokens:
    """Ids of a lower-casing word-end BPE vocabulary file of the ``tokenizers`` library.

    White space is dropped by the vocabulary's normaliser, so pieces between ASCII white
    space are encoded alone. Plain Latin pieces go through a rank encoder of the same
    merges, in which byte 0xFF (never part of UTF-8) marks the word's end; all others
    go to the library itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        spec = json.load(open(path))
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.findall = regex.compile(pattern).findall
        plain = {c: b for b, c in _byte_chars().items()}
        end = spec["model"]["end_of_word_suffix"]
        ranks, used = {}, set()
        for token, i in spec["model"]["vocab"].items():
            last = token.endswith(end)
            body = token[: -len(end)] if last else token
            if body and all(c in plain for c in body):
                key = bytes(plain[c] for c in body) + b"\xff" * last
                if key != b"\xff":
                    ranks[key] = i
                    used.add(i)
        ranks[b"\xff"] = next(i for i in range(1 << 30) if i not in used)
        self.ranks = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
        self.cache = Cache(self._encode)

    def _encode(self, piece: bytes) -> bytes:
        if piece.isalpha():  # ASCII letters only
            return self.word(piece.lower() + b"\xff")
        if piece.isascii():
            low = piece.lower()
            if low[:-1].isalpha() and not low[-1:].isalnum():
                return self.cache[low[:-1]] + self.cache[low[-1:]]
            text = low.decode()
        else:
            text = piece.decode()
            if max(text) >= "ƀ":
                return packed(self.whole.encode(text, add_special_tokens=False).ids)
            text = "".join(map(str.lower, unicodedata.normalize("NFC", text)))
            # lower-casing may end a letter in a mark, which then belongs to the marks after it
            if piece[-1] < 128 and not piece[-1:].isalnum() and len(piece) > 1 and text[:-1].isalpha():
                return self.cache[piece[:-1]] + self.cache[piece[-1:]]
            if text.isalpha():
                return self.word(text.encode() + b"\xff")
        if "<|" in text:
            return packed(self.whole.encode(piece.decode(), add_special_tokens=False).ids)
        return b"".join([self.word(x.encode() + b"\xff") for x in self.findall(text)])

    def word(self, ended: bytes) -> bytes:
        return packed(self.ranks._encode_single_piece(ended))

    def ids(self, text: bytes) -> bytes:
        return b"".join(map(self.cache.__getitem__, text.split()))


def _byte_chars() -> dict[int, str]:
    """Byte -> the printable character that stands for it in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in out)
    return out | {b: chr(256 + k) for k, b in enumerate(hidden)}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a rank file (base64 token, blank, rank on each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
