"""Token ids of whole texts by a byte-level BPE vocabulary file, cached by word."""

from __future__ import annotations

import base64
import json
import re

import numpy as np

#: A space before white space or at the end: only then may a token hold a space and what precedes it.
_ODD = re.compile(r" (?:\s|$)")
_CUT = re.compile(r" (?=\S)")
_LONGEST, _MOST = 48, 100_000
#: Words to keep where the encoder has its worker for itself: about 80 MB.
KEPT = 400_000


class Encoder:
    """encode(text): little-endian unsigned 32-bit ids as bytes, as the tokenizers library gives them for the same
    vocabulary. specials: strings that are one id each wherever they stand; without, all strings are ordinary text. The vocabulary's pattern never joins a single space to what
    stands before it, so a text is cut at such spaces and each piece is encoded by itself; pieces are mostly words, and
    are kept (at most `most` of at most _LONGEST characters)."""

    def __init__(self, path: str, pattern: str, specials: tuple[tuple[str, int], ...] = (), most: int = _MOST):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._ids = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._known: dict[str, bytes] = {}
        self._most = most
        self._special = {s: i.to_bytes(4, "little") for s, i in specials}
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self._special, key=len, reverse=True))) + ")") if specials else None

    def _bytes(self, text: str) -> bytes:
        return np.array(self._ids(text), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self._special):  # far faster than the pattern, where there is none
            return b"".join(self._special.get(part) or self._plain(part) for part in self._cut.split(text))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        head, *rest = _CUT.split(text) if _ODD.search(text) else text.split(" ")
        known = self._known
        out = [self._bytes(head)] if head else []
        for piece in rest:
            got = known.get(piece)
            if got is None:
                got = self._bytes(" " + piece)
                if len(piece) <= _LONGEST:
                    if len(known) >= self._most:
                        known.clear()
                    known[piece] = got
            out.append(got)
        return b"".join(out)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(*vocabulary, most: int = _MOST) -> Encoder:
    """One for each Python worker. vocabulary: path, pattern and, if any, specials; most: pieces that are kept."""
    if (key := (vocabulary, most)) not in _ENCODERS:
        _ENCODERS[key] = Encoder(*vocabulary, most=most)
    return _ENCODERS[key]


def public_vocabulary(name: str = "byte_bpe_50k") -> tuple[str, str]:
    """Path and pattern of a vocabulary of the box: name.tiktoken holds the ranks of name.json's ids."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN


def library_vocabulary(name: str = "byte_bpe_50k") -> tuple[str, str, tuple[tuple[str, int], ...]]:
    """public_vocabulary(), and the special tokens that the tokenizers library finds in texts by its defaults."""
    import public_tokenizers

    with open(public_tokenizers.path(f"{name}.json")) as f:
        added = json.load(f)["added_tokens"]
    return *public_vocabulary(name), tuple((t["content"], t["id"]) for t in added)
