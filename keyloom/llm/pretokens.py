"""Pre-tokens of byte-level BPE vocabularies: the split before any merge, and the byte alphabet of the JSON files."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache

import public_tokenizers
import regex
import tiktoken
from tokenizers import pre_tokenizers

#: Letters up to U+024F; texts of these, ASCII digits, punctuation and white space take the faster splitter.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_OTHER = re.compile(rf"[^\t-\r -~{_LETTERS}]")
# alternatives that start with different characters may be tried in any order: words, by far the most, come first
_QUICK = re.compile(rf" ?[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")
_WHOLE = regex.compile(public_tokenizers.PATTERN)


#: A letter, a number, a white space and another character on whose class all Unicode versions agree.
_LETTER, _NUMBER, _SPACE, _SIGN = "ª²\u3000§"

Classes = Callable[[Iterable[str]], dict[str, str]]


@lru_cache(maxsize=1 << 16)
def _settled(char: str) -> bool:
    """Whether the character's category has stayed the same since Unicode 3.2; libraries with tables of
    different versions split the others differently."""
    was = unicodedata.ucd_3_2_0.category(char)
    return was not in ("Cn", "Co", "Cs") and was == unicodedata.category(char)


def tokenizers_classes(chars: Iterable[str]) -> dict[str, str]:
    """How the tokenizers library classes characters: by what it keeps together."""
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    return {c: next((to for with_, to in (("a", _LETTER), ("1", _NUMBER), ("!", _SIGN)) if len(split(with_ + c)) == 1), _SPACE) for c in chars}


def tiktoken_classes(chars: Iterable[str]) -> dict[str, str]:
    """How the tiktoken library classes characters: a whole piece that is a token is not taken apart."""
    chars = sorted(chars)
    ranks = {bytes([b]): b for b in range(256)}
    for c in chars:
        for with_ in "a1!":
            ranks[(with_ + c).encode()] = len(ranks)
    probe = tiktoken.Encoding("classes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    whole = lambda s: probe.encode_ordinary(s) == [ranks[s.encode()]]
    # the joined bytes are reached by no merge, as the middle of a character is no token: only by whole pieces
    return {c: next((to for with_, to in (("a", _LETTER), ("1", _NUMBER), ("!", _SIGN)) if whole(with_ + c)), _SPACE) for c in chars}


_CLASSED: dict[tuple[Classes, str], str] = {}


def pretokens(text: str, classes: Classes) -> list[str]:
    """The pieces of a text that are merged separately, as the library of `classes` splits; joined they are
    the text."""
    if not _OTHER.search(text):
        return _QUICK.findall(text)
    if odd := [c for c in set(text) if not _settled(c)]:
        if new := [c for c in odd if (classes, c) not in _CLASSED]:
            _CLASSED.update({(classes, c): to for c, to in classes(new).items()})
        like = text.translate({ord(c): _CLASSED[classes, c] for c in odd})
        out, at = [], 0
        for piece in _WHOLE.findall(like):
            out.append(text[at : at + len(piece)])
            at += len(piece)
        return out
    return _WHOLE.findall(text)


@lru_cache(maxsize=1)
def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary file: printable bytes for
    themselves, the others for the code points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(maxsize=1)
def letter_bytes() -> dict[str, int]:
    return {c: b for b, c in byte_letters().items()}


@lru_cache(maxsize=1)
def _translation() -> dict[int, str]:
    return {b: c for b, c in byte_letters().items()}


def as_letters(piece: str) -> str:
    """A piece's UTF-8 bytes in the alphabet of the vocabulary file."""
    return piece.encode().decode("latin-1").translate(_translation())
