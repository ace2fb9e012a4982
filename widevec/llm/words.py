"""Exact encoding through the distinct words of a tokenizer.

Both public tokenizers cut a text before white space that follows something else, and
between a letter and a punctuation mark; no token reaches over such a cut. So a text's ids
are the ids of its words, and each distinct word needs one call into the library per Python
worker. Many texts at once are cut as one array of bytes and looked up by their distinct words.
"""

import codecs
import hashlib
import os
import re
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa

from widevec.llm.common import keeps

# White space as the tokenizers see it. Python also counts the four separators 1C to 1F.
GAP = r"[^\S\x1c-\x1f]"
INK = r"[\S\x1c-\x1f]"
WORD = re.compile(rf"{GAP}*{INK}+|{GAP}+\Z")
TWO_GAPS = re.compile(rf"{GAP}{GAP}")
# A word of plain letters, and what follows it from a punctuation mark on.
STEM = re.compile(r"( ?)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)(?:([!-/:-@\[-^`{-~]\S*))?\Z")
PROBES = (" Abc", "abc", " \u00c9t\u00e9", "\u00df\u00d8x", " I")

# A comma or full stop that does not follow a letter, a digit or a line end.
JOINED_MARK = re.compile(r"[^A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff\n][,.]")

# Distinct words that a worker keeps, in two halves of which the older one is dropped when the
# younger one is full, and the longest of them: some 130 MB.
KEPT_WORDS = 600_000
LONGEST_KEPT = 64

# Bytes of texts whose words are looked up together, unless one text alone has more.
BLOCK_BYTES = 1 << 21

_opened = keeps("words", {})


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_letters():
    """The letter that stands for each byte in byte-level vocabularies: itself where it can
    be seen, else the next letter from 256 on."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()
BYTE_TEXT = "".join(BYTE_LETTERS[b] for b in range(256))

# What a byte can be, as bits: white space; the end of something else; the end of a letter or
# digit; a comma or full stop; the first byte of what is no white space; that of what may be.
_GAP, _INK, _LETTER, _MARK, _FIRST, _OPEN = 1, 2, 4, 8, 16, 32
_KINDS = np.zeros(256, np.uint8)
_KINDS[[9, 10, 11, 12, 13, 32]] = _GAP
_KINDS[33:127] = _INK | _FIRST
_KINDS[0x80:] = _INK
_KINDS[[b for b in range(128) if chr(b).isalnum()]] |= _LETTER
_KINDS[[ord(","), ord(".")]] |= _MARK
_KINDS[0xC3:0xF5] |= _FIRST
_KINDS[[0xC2, 0xE1, 0xE2, 0xE3]] = _INK | _OPEN


def word_starts(codes, starts):
    """Where words begin in texts given as one array of UTF-8 bytes and the places where the
    texts begin.

    A word begins at white space that follows something else, at a comma or full stop that
    follows a letter or digit, and after a line end that stands alone. What the bytes around
    do not tell is not cut, which leaves a word longer, never wrong.
    """
    kind = _KINDS[codes]
    at = np.flatnonzero(kind & _OPEN)
    lead, one = codes[at], codes[at + 1]
    kind[at[(lead == 0xC2) & ((one == 0x85) | (one == 0xA0))] + 1] = 0
    at, lead, one = (x[lead != 0xC2] for x in (at, lead, one))
    two = codes[at + 2]
    wide = (lead == 0xE2) & (one == 0x80) & ((two <= 0x8A) | (two == 0xA8) | (two == 0xA9) | (two == 0xAF))
    wide |= (lead == 0xE2) & (one == 0x81) & (two == 0x9F) | (lead == 0xE1) & (one == 0x9A) & (two == 0x80)
    kind[at[wide | (lead == 0xE3) & (one == 0x80) & (two == 0x80)] + 2] = 0
    at = np.flatnonzero(codes == 0xC3) + 1
    kind[at[(codes[at] != 0x97) & (codes[at] != 0xB7)]] |= _LETTER
    cut = np.zeros(len(codes) + 1, bool)
    # Shifted so that a text's byte stands beside what the next one asks of it.
    asked = (kind[1:] & _GAP) * _INK | (kind[1:] & _MARK) // 2
    cut[1:-1] = kind[:-1] & asked
    # Nothing is known of what stands before a text.
    cut[starts] = False
    ends = np.flatnonzero((codes[:-1] == 10) & cut[:-2]) + 1
    cut[ends[kind[ends] & _FIRST != 0]] = True
    cut[starts] = True
    return cut[:-1]


class WordEncoder:
    """The ids of whole texts, as the library gives them without special tokens.

    Ids are little-endian unsigned 32-bit integers throughout, so that joining words is
    joining bytes.
    """

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.marks = [added.content for added in self.library.get_added_tokens_decoder().values()]
        self.known, self.older = {}, {}
        # Plain words skip the library's pattern matching if this gives just the same.
        self.direct = None
        for lower in (False, True):
            for space in (" ", ""):
                rule = lambda lead, word, lower=lower, space=space: (
                    (space if lead else "") + (word.lower() if lower else word)
                )
                if all(self._pieces(p) == [self._spelt(rule(p[: p[0] == " "], p.strip()))] for p in PROBES):
                    self.direct = self.direct or rule

    @staticmethod
    def _spelt(word):
        return word.encode("utf-8").decode("latin-1").translate(BYTE_LETTERS)

    def _pieces(self, word):
        library = self.library
        plain = library.normalizer.normalize_str(word) if library.normalizer else word
        return [piece for piece, _ in library.pre_tokenizer.pre_tokenize_str(plain)]

    def library_ids(self, text):
        return packed(self.library.encode(text, add_special_tokens=False).ids)

    def _model_ids(self, pieces):
        tokenize = self.model.tokenize
        return packed([t.id for piece in pieces for t in tokenize(piece)])

    def _word(self, word):
        plain = STEM.match(word) if self.direct else None
        if plain is None:
            return self._model_ids(self._pieces(word))
        lead, stem, rest = plain.groups()
        if rest:
            return self.one(lead + stem) + self.one(rest)
        return self._model_ids([self._spelt(self.direct(lead, stem))])

    def one(self, word):
        ids = self.known.get(word)
        if ids is None:
            ids = self.older.get(word)
            if ids is None:
                ids = self._word(word)
            if len(word) <= LONGEST_KEPT:
                self.known[word] = ids
        return ids

    def words_ids(self, words):
        """The ids of words, back to back."""
        if len(self.known) > KEPT_WORDS // 2:
            self.known, self.older = {}, self.known
        found = list(map(self.known.get, words))
        if None in found:
            found = [self.one(words[k]) if ids is None else ids for k, ids in enumerate(found)]
        return b"".join(found)

    def new_ids(self, words, marked=True):
        """The ids of each of some words that are not in ``known``, which they join; marked:
        whether the strings of special tokens may be among them."""
        found = list(map(self.older.get, words))
        stems = []
        for k, word in enumerate(words):
            if found[k] is not None:
                continue
            plain = STEM.match(word) if self.direct else None
            if marked and any(mark in word for mark in self.marks):
                found[k] = self.library_ids(word)
            elif plain and not plain[3]:
                stems.append((k, self.direct(plain[1], plain[2])))
            else:
                found[k] = self._word(word) if len(word) <= LONGEST_KEPT else self.unmarked(word)
        # No word of letters has the byte that parts them here, so its letter does.
        spelt = "\n".join(stem for _, stem in stems).encode("utf-8")
        spelt = codecs.charmap_decode(spelt, "strict", BYTE_TEXT)[0].split(BYTE_LETTERS[10])
        tokenize = self.model.tokenize
        for (k, _), piece in zip(stems, spelt):
            found[k] = packed([t.id for t in tokenize(piece)])
        self.known.update((word, ids) for word, ids in zip(words, found) if len(word) <= LONGEST_KEPT)
        return found

    def block_ids(self, codes, starts, end_id):
        """The ids of whole texts with ``end_id`` after each, and how many each has.

        codes: the texts' UTF-8 bytes, back to back; starts: where each begins, and the end.
        """
        marked = False
        if len(codes):
            cut = word_starts(codes, starts)
            content = codes.tobytes()
            for mark in self.marks:
                mark = mark.encode("utf-8")
                at = content.find(mark)
                while at >= 0:
                    marked = True
                    # This text is one word, that of the library.
                    k = np.searchsorted(starts, at, side="right")
                    cut[starts[k - 1] + 1 : starts[k]] = False
                    at = content.find(mark, starts[k])
            first = np.flatnonzero(cut).astype(np.int32)
            edges = pa.py_buffer(np.append(first, np.int32(len(codes))))
            words = pa.StringArray.from_buffers(len(first), edges, pa.py_buffer(content)).dictionary_encode()
            order, words = words.indices.to_numpy(), words.dictionary.to_pylist()
        else:
            first, order, words = np.zeros(0, np.int32), np.zeros(0, np.int32), []
        if len(self.known) > KEPT_WORDS // 2:
            self.known, self.older = {}, self.known
        ids = list(map(self.known.get, words))
        lost = [k for k, own in enumerate(ids) if own is None]
        for k, own in zip(lost, self.new_ids([words[k] for k in lost], marked)):
            ids[k] = own
        # The end of a text is a word of its own.
        ids.append(packed([end_id]))
        ends = np.searchsorted(first, starts[1:])
        order = np.insert(order, ends, len(words))
        flat = np.frombuffer(b"".join(ids), "<u4")
        sizes = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        begins = np.cumsum(sizes, dtype=np.int32) - sizes
        own = sizes[order]
        after = np.cumsum(own, dtype=np.int32)
        place = np.repeat(begins[order] - (after - own), own)
        place += np.arange(len(place), dtype=np.int32)
        return flat[place], np.diff(after[ends + np.arange(len(ends))], prepend=0)

    def blocks(self, column, end_id):
        """``block_ids`` of an Arrow column of texts without nulls, some texts at a time."""
        column = column.cast(pa.string())
        starts = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        codes = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + BLOCK_BYTES, side="right")) - 1)
            part = starts[at : to + 1]
            yield self.block_ids(codes[part[0] : part[-1]], part - part[0], end_id)
            at = to

    def joint(self, text):
        """The ids of a short stretch, mostly one word that is known."""
        ids = self.known.get(text)
        return self.unmarked(text) if ids is None else ids

    def encode(self, text):
        """A text with the string of a special token in it goes to the library whole."""
        if any(mark in text for mark in self.marks):
            return self.library_ids(text)
        return self.unmarked(text)

    def unmarked(self, text):
        if "\x00" in text or TWO_GAPS.search(text):
            return self.words_ids(WORD.findall(text))
        # Every gap stands alone: cutting before spaces and around line ends does the same, faster.
        cut = text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00")
        if not JOINED_MARK.search(text):
            cut = cut.replace(",", "\x00,").replace(".", "\x00.")
        return self.words_ids(cut.split("\x00"))


def word_encoder(name):
    """One encoder per Python worker and definition; ``name`` is a public tokenizer or a path."""
    path = name if os.path.sep in name else public_tokenizers.path(name)
    if path not in _opened:
        _opened[path] = WordEncoder(path)
    return _opened[path]


def sha256_hex(content):
    return hashlib.sha256(content).hexdigest()
