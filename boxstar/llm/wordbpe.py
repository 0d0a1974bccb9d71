"""Whitespace-unit encoder for the lower-casing word-end BPE vocabulary.

The vocabulary's pre-tokenizer never joins characters across white space, so
the ids of a text are the ids of its white-space-separated units in order.
Units repeat often; each worker remembers the ids of the units it has met and
encodes only new ones. New units go through ``tiktoken`` with the same merges
(the word end is one private character); texts with characters outside the
range checked for equal treatment, or with special-token strings, go through
the tokenizers library itself.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np

#: Units remembered per worker; the memory is dropped and refilled beyond it.
MAX_UNITS = 400_000

_END = "\ue000"
_SEP = "\x1f"  # texts that hold it go through the library
_SAFE_TOP = 0x250  # classes are built up to Latin Extended-B; texts are taken up to U+017F

_cache: dict[str, "UnitEncoder"] = {}


def encoder(path: str) -> "UnitEncoder":
    """The worker's encoder for a vocabulary file."""
    if path not in _cache:
        _cache[path] = UnitEncoder(path)
    return _cache[path]


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others take the code points from 256 on in ascending order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _ranges(points: list[int]) -> str:
    return "".join(f"\\u{p:04x}" for p in points)


class UnitEncoder:
    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.vocab = spec["model"]["vocab"]
        self.token_of = {i: t for t, i in self.vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        specials = [t["content"] for t in spec["added_tokens"]]
        self.suffix = spec["model"]["end_of_word_suffix"]
        back = _byte_of_char()

        def raw(token: str) -> bytes:
            body, end = (token[: -len(self.suffix)], _END.encode()) if token.endswith(self.suffix) else (token, b"")
            return bytes(back[c] for c in body) + end

        # the word end is assembled first (ranks 0 and 1), then joins its
        # character, as the vocabulary's base alphabet asks; merges follow
        e = _END.encode()
        ranks = {e[:2]: 0, e: 1}
        for token, i in self.vocab.items():
            ranks.setdefault(raw(token), i + 2)
        for b in range(256):  # bytes that no token has
            ranks.setdefault(bytes([b]), len(self.vocab) + 1000 + b)
        self.bpe = tiktoken.Encoding("units", pat_str=f"[^{_END}]+{_END}", mergeable_ranks=ranks, special_tokens={})
        self.sep_id = ranks[_SEP.encode() + e]
        self.no_token = len(self.vocab) + 1000

        cats = {p: unicodedata.category(chr(p)) for p in range(_SAFE_TOP)}
        space = [p for p in range(_SAFE_TOP) if chr(p).isspace()]
        letters = _ranges([p for p, c in cats.items() if c[0] == "L"])
        numbers = _ranges([p for p, c in cats.items() if c[0] == "N"])
        self.split = re.compile(f"{_SEP}|'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{_ranges(space)}{letters}{numbers}]+")
        # outside the checked range, and controls that split() takes for space
        self.odd = re.compile("[^\\x00-\\x1b\\x20-\\u017f]|\\x85|" + "|".join(re.escape(s) for s in specials))
        self.memo: dict[str, bytes] = {}

    def _learn(self, units: list[str]) -> None:
        """Encode units that are not remembered, all in one call.

        A control character that no plain text holds closes each unit; its
        token marks the unit's end among the ids.
        """
        joined = unicodedata.normalize("NFC", _SEP.join(units) + _SEP).lower()
        words = self.split.findall(joined)
        ids = np.array(self.bpe.encode_ordinary(_END.join(words) + _END), dtype=np.uint32)
        ends = np.flatnonzero(ids == self.sep_id)
        if len(ends) != len(units) or ids.max() >= self.no_token:
            # a byte without a token of its own: ask the library
            for u in units:
                self.memo[u] = np.array(self.library.encode(u, add_special_tokens=False).ids, dtype="<u4").tobytes()
            return
        flat = (ids - np.uint32(2)).astype("<u4").tobytes()
        stop = (ends * 4).tolist()
        start = [0, *[e + 4 for e in stop[:-1]]]
        self.memo.update(zip(units, [flat[i:j] for i, j in zip(start, stop)]))

    def ids_bytes(self, text: str) -> bytes:
        """Ids of a whole text as little-endian uint32, without special tokens added."""
        if self.odd.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return self.ids_many([text])[0]

    def ids_many(self, texts: list[str]) -> list[bytes]:
        """Ids of several texts; new units of all of them are learnt in one go."""
        odd = self.odd.search
        plain = [None if odd(t) else t.split() for t in texts]
        if len(self.memo) > MAX_UNITS:
            self.memo.clear()
        memo = self.memo
        new = [u for u in set().union(*[units for units in plain if units]) if u not in memo]
        if new:
            self._learn(new)
        return [
            self.ids_bytes(t) if units is None else b"".join([memo[u] for u in units]) for t, units in zip(texts, plain)
        ]
