"""Whole-text encoding with the tokenizers library, one distinct chunk at a time.

Both vocabularies used here split a text at white space before any merge, so
the ids of a text are the ids of its chunks put together. A chunk seen before
is looked up (a bounded table per Python worker); a new one goes through the
library. Splitting is done only where no pre-token can cross:

* ``leading``: byte-level BPE whose pre-tokens may start with one space. A cut
  is made before a single space, and around a single line feed, between two
  characters that are not white space. Any text with other white space runs is
  cut by ``_SAFE`` only at such places.
* ``dropped``: white space separates pre-tokens and is removed. Cuts are made at
  ASCII white space.
* ``whole``: any other tokenizer gets whole texts.

A text with the string of a special token goes to the library as a whole, which
gives it that token's id, as the library does by default.
"""

from __future__ import annotations

import json
import os
import re

_SAFE = re.compile(r"(?<=[!-~\w])(?= [!-~\w])|(?<=[!-~\w])(?=\n[!-~\w])|(?<=[!-~\w]\n)(?=[!-~\w])")
_ASCII_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_PUNCTUATION = ".,;:!?"
# Chunks longer than this are never kept in the table.
LONGEST_KEPT = 64


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes each byte as a printable character: the printable
    Latin-1 bytes as themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(other)}


class ChunkEncoder:
    """encode(text) -> ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, limit: int = 700_000):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model, self.limit = self.tok.model, limit
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = [t["content"] for t in spec.get("added_tokens") or []]
        # a normaliser may change the case before they are looked for
        self.special = re.compile("|".join(map(re.escape, added)), re.I) if added else None
        self.hint = os.path.commonprefix(added)
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        steps = pre.get("pretokenizers", [])
        if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
            self.mode = "leading"
        elif (norm and steps and steps[0].get("type") == "Split" and steps[0].get("invert")
              and "\\s" in steps[0]["pattern"].get("Regex", "") and steps[-1].get("type") == "ByteLevel"
              and any(n.get("type") == "Lowercase" for n in norm.get("normalizers", []))):
            self.mode = "dropped"
        else:
            self.mode = "whole"
        self.letters = _byte_letters()
        self.inner: dict[str, bytes] = {}   # chunks at the start of a line, or without a space
        self.spaced: dict[str, bytes] = {}  # chunks after a single space
        self.marks: dict[str, bytes] = {}
        self.packed = [i.to_bytes(4, "little") for i in range(max(self.tok.get_vocab().values()) + 1)]
        self.inner[""] = b""
        self.newline = self._library("\n")

    def _library(self, text: str) -> bytes:
        return self._pack(self.tok.encode(text, add_special_tokens=False).ids)

    def _pack(self, ids) -> bytes:
        return b"".join([self.packed[i] for i in ids])

    def _new(self, chunk: str, space: str) -> bytes:
        """The library's ids of a chunk that is not in the table. A word of plain
        letters with closing marks needs no splitting, so its letters go to the
        library's model directly."""
        if chunk[:1] == "\n" and space:
            return self.newline + (self._one(chunk[1:], "") if len(chunk) > 1 else b"")
        return self._one(chunk, space)

    def _one(self, chunk: str, space: str) -> bytes:
        core = chunk.rstrip(_PUNCTUATION)
        if not core.isalpha() or len(core) > LONGEST_KEPT:
            return self._library(space + chunk)
        text = core.lower() if self.mode == "dropped" else space + core
        if not core.isascii():
            if max(core) >= "ɐ" or "İ" in core:
                return self._library(space + chunk)
            text = text.encode().decode("latin-1").translate(self.letters)
        elif space and self.mode != "dropped":
            text = self.letters[0x20] + core
        out = b"".join([self.packed[t.id] for t in self.model.tokenize(text)])
        if len(core) < len(chunk):
            rest = chunk[len(core):]
            if rest not in self.marks:
                if len(self.marks) > 10_000:
                    self.marks.clear()
                self.marks[rest] = self._library(rest)
            out += self.marks[rest]
        return out

    def _join(self, table: dict, chunks: list[str], space: str) -> bytes:
        try:
            return b"".join(map(table.__getitem__, chunks))
        except KeyError:
            pass
        out, get, room = [], table.get, self.limit - len(table)
        for c in chunks:
            ids = get(c)
            if ids is None:
                ids = self._new(c, space)
                if room > 0 and len(c) <= LONGEST_KEPT:
                    table[c] = ids
                    room -= 1
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.mode == "whole" or (self.special and self.hint in text and self.special.search(text)):
            return self._library(text)
        flat = text.replace("\n", " ")
        if self.mode == "dropped":
            words = flat.split(" ") if flat.isprintable() else _ASCII_SPACE.split(text)
            return self._join(self.inner, words, "")
        # isprintable: of all white space, only the plain space is left
        if not flat.isprintable() or "  " in flat or flat[0] == " " or flat[-1] == " ":
            return self._join(self.inner, _SAFE.split(text), "")
        first, *rest = text.replace("\n", " \n").split(" ")
        return self._join(self.inner, [first], "") + self._join(self.spaced, rest, " ")


_ENCODERS: dict[tuple[str, int], ChunkEncoder] = {}


def encoder(path: str, limit: int = 700_000) -> ChunkEncoder:
    """One encoder per Python worker and tokenizer file."""
    if (path, limit) not in _ENCODERS:
        _ENCODERS[path, limit] = ChunkEncoder(path, limit)
    return _ENCODERS[path, limit]
