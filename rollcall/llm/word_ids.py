"""Ids of whole texts by the tokenizers library, word by word.

A pre-token never reaches over the start of a run of white space, so a text
may be cut there and each piece (white space and the word after it) encoded
alone.  A text that holds the text of a special token is encoded whole, so that
it becomes what the library's own ``encode(text, add_special_tokens=False)`` gives.  Arrow cuts a batch of texts and numbers its distinct pieces; their ids
are kept per Python worker, and a missing piece is pre-tokenised and merged by
the library's own parts.  At byte level Arrow also parts the distinct pieces
into a word and the marks after it, so a word is merged and kept once whatever
follows it.
"""

from __future__ import annotations

import codecs
import functools
import os
import re
import string
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces and pre-tokens kept in a worker; beyond that new ones are encoded without being kept.
CACHE_ENTRIES = 250_000
_PIECES = re.compile(r"\s*\S+|\s+")
_CONTROL = re.compile("[\x1c-\x1f\x00]")   # white space to Python, symbols to the tokenizers
#: Texts that are not words with one space or line end between them are cut one at a time.
_UNEVEN = (r"[ \n][ \n]|^[ \n]|[ \n]$|"
           r"[\x00\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
#: Bytes of text that are cut at a time.
_SLICE_BYTES = 4 << 20
#: Words below this character lower and compose alike everywhere, letter by letter.
_PLAIN_BELOW = "\u0130"
#: Marks after a word that are parted from it, at most so many; longer runs stay in their piece.
_MARKS, _MOST_MARKS = string.punctuation, 8


class _Alphabet(dict):
    """A letter's UTF-8 bytes in the alphabet of byte-level models, as the library spells them."""

    def __missing__(self, letter: str) -> str:
        from tokenizers.pre_tokenizers import ByteLevel
        spelt = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(letter)[0][0]
        self[letter] = spelt
        return spelt


@functools.cache
def _byte_spelling() -> str:
    """The character of each byte in the alphabet of byte-level models; control bytes and the like follow in order from U+0100 on."""
    from tokenizers.pre_tokenizers import ByteLevel
    own, shifted = set(ByteLevel.alphabet()), map(chr, range(256, 512))
    return "".join(chr(b) if chr(b) in own else next(shifted) for b in range(256))


def _beyond_plain(words: pa.Array) -> np.ndarray:
    """Which words hold a character from ``_PLAIN_BELOW`` on."""
    _, offsets, data = words.buffers()
    bounds = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words) + 1]
    raw = np.frombuffer(data, np.uint8)[:bounds[-1]] if data else np.zeros(0, np.uint8)
    first, second = _PLAIN_BELOW.encode()
    at = np.flatnonzero(raw >= first)
    at = at[(raw[at] > first) | (raw[np.minimum(at + 1, len(raw) - 1)] >= second)]
    return np.searchsorted(at, bounds[1:]) > np.searchsorted(at, bounds[:-1])


def _little_endian(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class WordEncoder(dict):
    """Maps a piece to its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, lower: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        #: White space is dropped and letters lowered (word ends), or kept in front of a word (byte level).
        self.lower = lower
        self.tokens: dict[str, bytes] = {}
        self.alphabet = _Alphabet()
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Texts the library cuts by more than words: control characters, and tokens it looks for in the raw text.
        self.whole = re.compile("|".join([_CONTROL.pattern, *added]))
        self.uneven = "|".join([_UNEVEN, *added])

    def merged(self, token: str) -> bytes:
        """Ids of one pre-token in the model's alphabet."""
        ids = self.tokens.get(token)
        if ids is None:
            ids = _little_endian([t.id for t in self.model.tokenize(token)])
            if len(self.tokens) < CACHE_ENTRIES:
                self.tokens[token] = ids
        return ids

    def __missing__(self, piece: str) -> bytes:
        start, whole = b"", piece
        if not self.lower and piece[0] == "\n" and piece[1:2].isalpha():
            start, piece = self.merged(self.alphabet["\n"]), piece[1:]
        body = piece.rstrip(".,")
        word = body if self.lower else body.removeprefix(" ")
        if word.isalpha() and (word.isascii() or max(word) < _PLAIN_BELOW):
            token = word.lower() if self.lower else word
            if not token.isascii():
                token = "".join(map(self.alphabet.__getitem__, token))
            ids = self.merged("Ġ" + token if len(word) < len(body) else token)
            if len(body) < len(piece):
                ids += self.merged(piece[len(body):])
        else:
            normal = self.tokenizer.normalizer
            text = normal.normalize_str(piece) if normal else piece
            ids = b"".join([self.merged(t) for t, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)])
        ids = start + ids
        if len(self) < CACHE_ENTRIES:
            self[whole] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of one text, whatever its white space."""
        if self.whole.search(text):
            return _little_endian(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.__getitem__, text.split() if self.lower else _PIECES.findall(text)))

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text of a string array; a null text has none."""
        return list(self.encode_each(texts))

    def encode_each(self, texts: pa.Array) -> Iterator[bytes]:
        """``encode_all`` one text after the other; the texts of about ``_SLICE_BYTES`` are encoded ahead."""
        texts, start = texts.fill_null("") if texts.null_count else texts, 0
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        while start < len(texts):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + _SLICE_BYTES)))
            yield from self._encode_slice(texts.slice(start, stop - start))
            start = stop

    def _merge_words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words of letters, with the space before them if any, of a byte-level model."""
        spelling, tokenize = _byte_spelling(), self.model.tokenize
        spelt = codecs.charmap_decode("\n".join(words).encode(), "strict", spelling)[0].split(spelling[10])
        for word, token in zip(words, spelt, strict=True):
            ids = _little_endian([t.id for t in tokenize(token)])
            if len(self) < CACHE_ENTRIES:
                self[word] = ids
            yield ids

    def _known(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces of a byte-level model; a word is looked up once whatever marks follow it.

        Marks of ASCII that end a piece are one pre-token, and so are the letters before them.
        """
        body = pc.utf8_rtrim(pieces, _MARKS)
        new_line = pc.starts_with(body, "\n")
        core = pc.if_else(new_line, pc.utf8_slice_codeunits(body, 1), body)
        spaced = pc.starts_with(core, " ")
        word = pc.if_else(spaced, pc.utf8_slice_codeunits(core, 1), core)
        marks = pc.subtract(pc.binary_length(pieces), pc.binary_length(body))
        is_word = pc.and_(pc.and_(pc.utf8_is_alpha(word), pa.array(~_beyond_plain(word))),
                          pc.and_(pc.less_equal(marks, _MOST_MARKS), pc.invert(pc.and_(new_line, spaced))))
        keys = pc.if_else(is_word, core, pieces).dictionary_encode()
        words = np.zeros(len(keys.dictionary), bool)
        words[keys.indices.to_numpy()[is_word.to_numpy(zero_copy_only=False)]] = True
        listed = keys.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.get, listed))
        missing = [i for i, found in enumerate(ids) if found is None]
        letters = [i for i in missing if words[i]]
        if letters:
            for i, merged in zip(letters, self._merge_words([listed[i] for i in letters]), strict=True):
                ids[i] = merged
        for i in missing:
            if not words[i]:
                ids[i] = self[listed[i]] if listed[i] else b""
        none = pa.scalar(b"", pa.binary())
        start = pc.if_else(pc.and_(is_word, new_line), pa.scalar(self.merged(self.alphabet["\n"]), pa.binary()), none)
        ends, number = [b""], np.zeros(len(pieces), np.int64)
        marks = np.where(is_word.to_numpy(zero_copy_only=False), marks.to_numpy(), 0)
        for n in range(1, _MOST_MARKS + 1):
            at = np.flatnonzero(marks == n)
            if len(at):
                found = pc.utf8_slice_codeunits(pieces.take(pa.array(at)), -n, None).dictionary_encode()
                number[at] = found.indices.to_numpy() + len(ends)
                ends += [self.merged(m) for m in found.dictionary.to_pylist()]
        end = pa.array(ends, pa.binary()).take(pa.array(number))
        return pc.binary_join_element_wise(start, pa.array(ids, pa.binary()).take(keys.indices), end, none)

    def _encode_slice(self, texts: pa.Array) -> list[bytes]:
        uneven = pc.match_substring_regex(texts, self.uneven).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(uneven), "", texts)
        if self.lower:
            cut = pc.split_pattern(pc.replace_substring(plain, "\n", " "), " ")
        else:
            plain = pc.replace_substring(pc.replace_substring(plain, " ", "\0 "), "\n", "\0\n")
            cut = pc.split_pattern(plain, "\0")
        pieces = cut.flatten().dictionary_encode()
        if self.lower:
            known = pa.array([self[p] if p else b"" for p in pieces.dictionary.to_pylist()], pa.binary())
        else:
            known = self._known(pieces.dictionary)
        ids = known.take(pieces.indices)
        starts = cut.offsets.to_numpy()
        bounds = np.frombuffer(ids.buffers()[1], np.int32)[starts - starts[0]]
        data = ids.buffers()[2].to_pybytes() if ids.buffers()[2] else b""
        return [self.encode(texts[i].as_py()) if odd else data[bounds[i]:bounds[i + 1]] for i, odd in enumerate(uneven)]


_ENCODERS: dict[tuple[str, bool], WordEncoder] = {}


def encoder(path: str, lower: bool) -> WordEncoder:
    """The encoder of this Python worker; it outlives a task."""
    if (path, lower) not in _ENCODERS:
        _ENCODERS[path, lower] = WordEncoder(path, lower)
    return _ENCODERS[path, lower]
