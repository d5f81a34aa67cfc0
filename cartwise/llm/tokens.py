"""Whole-text encoding by public tokenizer files with bounded caches of words and pieces.

Every tokenizer that is taken apart here splits a text before each space that a visible character follows, whatever
stands around it. So a text's ids are the joined ids of its units (words with their punctuation), a
unit's ids those of its pieces, and what was seen before costs one dictionary lookup. Caches are
bounded in bytes, keep nothing longer than a few times ``LONGEST`` characters (a text without spaces is one unit), and only
ever save time.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable
from string import punctuation

import numpy as np

from cartwise.llm.common import holds_caches

UNITS, PIECES = 48_000_000, 24_000_000  # bytes of one cache generation; there are two
LONGEST = 16  # characters of a unit or piece that is kept: longer ones seldom come back
_ENTRY = 190  # bytes of a dictionary entry with the heads of its text and its ids; a character takes 4 at most
_SPLIT = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?:\s|$)")


class Cache(dict):
    """Key -> ids, made on the first lookup (``__getitem__``) and kept within bounds.

    A full young generation becomes the old one; a hit there makes an entry young again.
    """

    def __init__(self, make: Callable[[str], bytes], most: int, longest: int = LONGEST):
        self.make, self.most, self.longest = make, most, longest
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.old: dict[str, bytes] = {}
        self.held: dict[str, bytes] = {}  # beside the generations, until it is replaced
        self.size = 0

    def __missing__(self, key: str) -> bytes:
        value = self.held.get(key) or self.old.get(key) or self.make(key)
        n = len(key)
        if n <= self.longest:
            more = _ENTRY + 4 * n + len(value)
            if self.size + more > self.most:
                self.put(key, value)
            else:  # nearly always: as ``put`` does it, without the call
                self.size += more
                self[key] = value
        return value

    def put(self, key: str, value: bytes) -> None:
        size = self.size + _ENTRY + 4 * len(key) + len(value)
        if size > self.most:
            self.old, size = self.copy(), size - self.size
            self.clear()
        self.size = size
        self[key] = value

    def unknown(self, keys: set[str]) -> list[str]:
        """The keys that neither generation holds; the older ones among the others are held until the next call."""
        lost, old, self.held = [], self.old.get, {}
        for k in keys.difference(self):
            value = old(k)
            if value is None:
                lost.append(k)
            else:
                self.held[k] = value
        return lost

    def learn(self, keys: list[str], values: list[bytes]) -> None:
        """Keep the values of unknown keys; what is too long to be kept is held until the next call of ``unknown``."""
        longest, put = self.longest, self.put
        for k, v in zip(keys, values):
            if len(k) > longest:
                self.held[k] = v
            else:
                put(k, v)


class TextEncoder:
    """Text -> ids packed as little-endian unsigned 32-bit integers.

    ``split`` gives the pieces of a text or unit, ``encode`` the packed ids of distinct pieces all at once. A
    text that holds one of ``special`` may not be split: ``whole`` encodes it.
    """

    def __init__(self, split: Callable[[str], list[str]], encode: Callable[[list[str]], list[bytes]], cache: tuple[int, int] | None = None):
        self.split, self.encode = split, encode
        units, pieces = cache or (UNITS, PIECES)
        # its pieces cost far more to encode than the library's, so longer ones are worth keeping
        self.units = Cache(lambda u: self._fresh([" " + u])[0], units, 3 * LONGEST)
        self.pieces = Cache(lambda p: encode([p])[0], pieces, 3 * LONGEST)

    def clear(self) -> None:
        self.units.forget()
        self.pieces.forget()

    def _fresh(self, units: list[str]) -> list[bytes]:
        split = [self.split(u) for u in units]
        lost = self.pieces.unknown({p for s in split for p in s})
        self.pieces.learn(lost, self.encode(lost) if lost else [])
        ids_of = self.pieces.__getitem__
        return [ids_of(s[0]) if len(s) == 1 else b"".join(map(ids_of, s)) for s in split]

    def __call__(self, text: str | None) -> bytes:
        return self.many([text])[0]

    def many(self, texts: list) -> list[bytes]:
        """Packed ids of each text; what is new in any of them is encoded in one go."""
        parts = [_units(t) if t else [] for t in texts]
        lost = self.units.unknown({u for p in parts for u in p[1:]})
        self.units.learn(lost, self._fresh([" " + u for u in lost]))
        ids_of = self.units.__getitem__
        heads = self._fresh([p[0] for p in parts if p])
        heads.reverse()
        return [heads.pop() + b"".join(map(ids_of, p[1:])) if p else b"" for p in parts]


def _units(text: str) -> list[str]:
    """The text cut before each space that a visible character follows; all but the first lack that space."""
    return _SPLIT.split(text) if _ODD.search(text) else text.split(" ")


class LibraryEncoder:
    """The same for a tokenizer of the library, unit by unit: its model encodes a piece at a time.

    ``unit`` gives the packed ids of a unit (without its leading space), ``head`` those of what stands before the first space;
    ``None``: white space is dropped, and every unit is treated alike. ``pieces`` is the cache that both take pieces from.
    """

    def __init__(self, unit: Callable[[str], bytes], head: Callable[[str], bytes] | None, pieces: Cache, special: tuple[str, ...], whole: Callable[[str], bytes], most: int):
        self.units, self.pieces = Cache(unit, most), pieces
        self.head, self.special, self.whole = head, special, whole

    def clear(self) -> None:
        self.units.forget()
        self.pieces.forget()

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        for w in self.special:
            if w in text:
                return self.whole(text)
        if self.head is None:
            return b"".join(map(self.units.__getitem__, text.replace("\n", " ").split(" ")))
        head, *rest = _units(text)
        return self.head(head) + b"".join(map(self.units.__getitem__, rest))

    def many(self, texts: list) -> list[bytes]:
        return [self(t) for t in texts]


class WholeTexts:
    """A tokenizer whose splitting is not known here: whole texts go to the library."""

    def __init__(self, whole: Callable[[str], bytes]):
        self.whole = whole

    def clear(self) -> None:
        pass

    def __call__(self, text: str | None) -> bytes:
        return self.whole(text) if text else b""

    def many(self, texts: list) -> list[bytes]:
        return [self(t) for t in texts]


# the public byte-level split pattern
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# its matches in ASCII text (white space spelt out: Python's holds four control characters more)
_ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")
# characters that lower one to one and compose with nothing that follows inside the set
_SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ÿ]*\Z")
_SIMPLE_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")

# the parts of a tokenizer file that drops white space and case (fixed values of the format)
_DROPS = {
    "normalizer": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    "split": {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
}

_ENCODERS: dict[tuple, LibraryEncoder | WholeTexts] = {}


def _clear() -> None:
    for e in _ENCODERS.values():
        e.clear()


holds_caches("tokens", _clear)


def _kind(config: dict) -> str:
    """How a file splits texts: ``bytes`` (byte level, spaces kept), ``drop`` (white space and case dropped) or ``other``."""
    normal, pre = config["normalizer"] or {}, config["pre_tokenizer"] or {}
    if config["model"].get("type") != "BPE":
        return "other"
    if not normal and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
        return "bytes"
    parts = pre.get("pretokenizers", [])
    if normal.get("normalizers") == _DROPS["normalizer"] and len(parts) == 2 and parts[0] == _DROPS["split"]:
        if parts[1]["type"] == "ByteLevel" and not parts[1]["use_regex"] and not parts[1]["add_prefix_space"]:
            return "drop"
    return "other"


def library_encoder(path: str, cache: tuple[int, int] | None = None) -> LibraryEncoder | WholeTexts:
    """The encoder of a ``tokenizers`` file, one per worker process (its caches live on between tasks).

    ``cache``: bytes of a generation for units and for pieces.

    The file's own settings decide how texts are split. Pieces are the library's: its model encodes each. The two
    kinds of file known here are split by the same published patterns, which is quicker; units that the quick
    patterns do not cover go through the library's normaliser and pre-tokenizer, and other files take whole texts.
    """
    key = (path, cache)
    if key not in _ENCODERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        model, normal, pre = t.model, t.normalizer, t.pre_tokenizer
        byte_chars = _byte_characters()
        gap = regex.compile(BYTE_LEVEL)
        tokenize = model.tokenize

        def piece(p: str) -> bytes:
            return array("I", [x.id for x in tokenize(p)]).tobytes()

        most_units, most_pieces = cache or (UNITS, PIECES)
        pieces = Cache(piece, most_pieces)
        ids_of = pieces.__getitem__

        def general(unit: str) -> bytes:
            return b"".join([ids_of(p) for p, _ in pre.pre_tokenize_str(normal.normalize_str(unit) if normal else unit)])

        def spaced(unit: str) -> bytes:
            if unit.isascii():  # the same matches by the plain classes
                found = _ASCII_PIECES.findall(unit)
                if unit.isprintable():
                    return b"".join([ids_of(p.replace(" ", "\u0120")) for p in found])
            else:
                found = gap.findall(unit)
            return b"".join([ids_of(p.encode().decode("latin-1").translate(byte_chars)) for p in found])

        def spelled(word: str) -> str:
            return "\u0120" + word.encode().decode("latin-1").translate(byte_chars)

        def byte_level(unit: str) -> bytes:
            # most units: a word (one piece, kept as a unit), or a word and its marks (one piece more); either may know the word
            if unit.isalpha():
                p = "\u0120" + unit if unit.isascii() else spelled(unit)
                return pieces.get(p) or piece(p)
            word = unit.rstrip(punctuation)
            if word.isalpha():
                return (units.get(word) or units.old.get(word) or ids_of(spelled(word))) + ids_of(unit[len(word) :])
            # a single line break is a piece of its own, and no piece crosses it
            before, _, after = unit.partition("\n")
            if before and after and not before[-1].isspace() and not after[0].isspace():
                return units[before] + ids_of("\u010a") + (ids_of(after) if after.isascii() and after.isalpha() else spaced(after))
            return spaced(" " + unit)

        def simple(unit: str) -> bytes:
            if unit.isascii():
                if unit.isalpha():
                    return piece(unit.lower())
                word = unit[:-1]
                if word.isalpha() and unit[-1] in ".,;:!?":
                    return ids_of(word.lower()) + ids_of(unit[-1])
            if not _SIMPLE.match(unit):
                return general(unit)
            found = _SIMPLE_PIECES.findall(unit.lower())
            if unit.isascii():
                return b"".join([ids_of(p) for p in found])
            return b"".join([ids_of(p.encode().decode("latin-1").translate(byte_chars)) for p in found])

        def whole(text: str) -> bytes:
            return np.asarray(t.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4").tobytes()

        special = tuple(x.content for x in t.get_added_tokens_decoder().values())
        kind = _kind(json.loads(t.to_str()))
        if kind == "other":
            _ENCODERS[key] = WholeTexts(whole)
        elif kind == "bytes":
            made = LibraryEncoder(byte_level, spaced, pieces, special, whole, most_units)
            units = made.units
            _ENCODERS[key] = made
        else:
            _ENCODERS[key] = LibraryEncoder(simple, None, pieces, special, whole, most_units)
    return _ENCODERS[key]


def _byte_characters() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
