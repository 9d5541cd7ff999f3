"""A public vocabulary file as a codec that remembers the chunks it has seen.

White space splits a text at places where the library's own splitting starts
anew.  Between two such places a chunk has the same ids in any text, so a
bounded memory of chunks answers most of them.  Any chunk that is not plain goes
to the library as it is.
"""

from __future__ import annotations

import functools
import json
import re
from struct import pack

import numpy as np

#: Chunks of each kind that one worker remembers before it starts afresh; some 150 MB.
MEMORY = 800_000
#: Marks that make one piece when they follow a word.
MARKS = ".,;:!?#*$%&|<>()"

#: White space beyond the six ASCII characters; where a text has it, the library splits it.
RARE_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Characters that the normalisers change by lower case alone.
PLAIN = re.compile("[\x20-\x7e\n\xc0-\xff]+")
#: A space in front of a word: the byte-level pattern always starts a piece there.
BEFORE_WORD = re.compile(r" (?=\S)")


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


def _is_word(chunk: str) -> bool:
    """Letters alone, all of them plain."""
    return chunk.isalpha() and (chunk.isascii() or PLAIN.fullmatch(chunk) is not None)


class _Memory(dict):
    def __init__(self, answer, most: int):
        super().__init__()
        self.answer, self.most = answer, most

    def __missing__(self, key):
        value = self.answer(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


class Codec:
    """Ids as ``tokenizers`` gives them without truncation, padding and added special tokens."""

    def __init__(self, path: str, memory: int = MEMORY):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        size = max([0, *self.library.get_vocab(with_added_tokens=True).values()]) + 1
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.shown = [self.library.id_to_token(i) for i in range(size)]
        self.decoder = spec["decoder"]
        self.letters = _byte_letters()
        self.decimals = [str(i) for i in range(size)]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.lower, self.cut, pattern = self._splitting(spec)
        if self.cut:
            import regex

            self.pattern = regex.compile(pattern)
            self.pieces = _Memory(self._piece, memory)
            self.chunks = _Memory(self._chunk, memory)
            self.spaced = _Memory(self._spaced, memory)

    def _splitting(self, spec: dict) -> tuple[bool, str, str]:
        """Lower case?, where chunks may be cut, the pattern of the pieces inside; no cut for other kinds of files."""
        model, pre, normal = spec["model"], spec["pre_tokenizer"] or {}, spec["normalizer"]
        if model["type"] != "BPE" or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]
                                         for t in spec["added_tokens"]) or any(re.search(r"\s", s) for s in self.special):
            return False, "", ""
        if normal is None and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
            from public_tokenizers import PATTERN

            return False, "word", PATTERN
        steps = [n["type"] for n in (normal or {}).get("normalizers", [])]
        parts = pre.get("pretokenizers", [{}])
        if (steps == ["NFC", "Replace", "Lowercase"] and len(parts) == 2 and parts[0].get("type") == "Split"
                and parts[0]["behavior"] == "Removed" and parts[0]["invert"] and parts[1]["type"] == "ByteLevel"
                and not parts[1]["use_regex"] and not parts[1]["add_prefix_space"]):
            return True, "space", parts[0]["pattern"]["Regex"]
        return False, "", ""

    def _plain(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _packed(self, ids: list[int]) -> bytes:
        return pack(f"<{len(ids)}{self.dtype.char}", *ids)

    def _letters_of(self, piece: str) -> str:
        return "".join([self.letters[b] for b in piece.encode()])

    def _piece(self, piece: str) -> bytes:
        return self._packed([t.id for t in self.library.model.tokenize(self._letters_of(piece))])

    def _word(self, word: str, before: str = "") -> bytes:
        """Ids of a word of letters, with the printable letter of the blank before it; ASCII letters stand for themselves."""
        shown = before + (word if word.isascii() else self._letters_of(word))
        return self._packed([t.id for t in self.library.model.tokenize(shown)])

    def _chunk(self, chunk: str) -> bytes:
        # A word of letters, perhaps with marks behind it: one piece each.
        if _is_word(chunk):
            low = chunk.lower() if self.lower else chunk
            return self._word(chunk) if low == chunk else self.chunks[low]
        core = chunk.rstrip(MARKS)
        if len(core) < len(chunk) and _is_word(core):
            return self.chunks[core.lower() if self.lower else core] + self.pieces[chunk[len(core):]]
        if not PLAIN.fullmatch(chunk) or any(s in chunk for s in self.special):
            return self._packed(self._plain(chunk))
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(chunk.lower() if self.lower else chunk)))

    def _spaced(self, chunk: str) -> bytes:
        """A chunk with a blank before it."""
        if _is_word(chunk):
            return self._word(chunk, self.letters[32])
        core = chunk.rstrip(MARKS)
        if len(core) < len(chunk) and _is_word(core):
            return self.spaced[core] + self.pieces[chunk[len(core):]]
        return self._chunk(" " + chunk)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, packed as unsigned integers of ``dtype``."""
        if not self.cut or RARE_SPACE.search(text):
            return np.array(self._plain(text), self.dtype).tobytes()
        if self.cut == "space":
            return b"".join(map(self.chunks.__getitem__, text.split()))
        # Where each blank stands before a word, a plain split gives the same chunks.
        blanks = any(x in text for x in ("  ", " \n", "\t", "\r", "\x0b", "\x0c")) or text.endswith(" ")
        first, *rest = BEFORE_WORD.split(text) if blanks else text.split(" ")
        return self.chunks[first] + b"".join(map(self.spaced.__getitem__, rest))

    def forget(self) -> None:
        """Drops the remembered chunks; they come back as texts need them."""
        for memory in (self.pieces, self.chunks, self.spaced) if self.cut else ():
            memory.clear()

    def decode(self, ids: list[int]) -> str:
        """The text as the library's decode() gives it, special tokens included."""
        if self.decoder is None:
            return " ".join(map(self.shown.__getitem__, ids))
        return self.library.decode(ids, skip_special_tokens=False)

    def digits(self, ids: list[int]) -> str:
        """The ids in decimal, joined by blanks."""
        return " ".join(map(self.decimals.__getitem__, ids))

    def tokens(self, text: str) -> np.ndarray:
        """Id, start and end (code points of ``text``) of each token, one row a token, from the library."""
        found = self.library.encode(text, add_special_tokens=False)
        out = np.empty((len(found.ids), 3), np.int32)
        out[:, 0] = found.ids
        out[:, 1:] = np.array(found.offsets, np.int32).reshape(-1, 2)
        return out


@functools.cache
def codec(path: str, memory: int = MEMORY) -> Codec:
    """One codec a worker process."""
    return Codec(path, memory)
