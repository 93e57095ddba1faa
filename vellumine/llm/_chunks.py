"""Library tokenizers applied part by part, each distinct part once.

Both pre-tokenizers used here never join a character to white space that
follows it, nor a Latin letter to ASCII punctuation or a digit beside it, so a
text falls into parts whose token sequences, put together, are those of the
whole text.  Texts are mostly words in ever new order: a worker remembers the
parts that it has met, and the library encodes the others in large batches.
"""

from __future__ import annotations

import gc
import os
import re
from array import array
from collections.abc import Iterable

from vellumine.llm._shared import together

#: Distinct parts in each of two generations that a worker remembers; this bounds its memory.
REMEMBERED = 400_000
#: Characters of text that are taken together.
TOGETHER = 4_000_000

#: A run of Latin letters between runs of ASCII characters that are neither letters nor blanks nor apostrophes.
_word = re.compile(r"([!-&(-@[-`{-~]*)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-@[-`{-~]*)\Z")
_awkward = re.compile(r"\s \s|\s \Z|\A \s|  ")
_runs = re.compile(r"\s*\S+|\s+")

_held: dict[tuple[str, bool, bool], ChunkTokenizer] = {}


class Memory:
    """Two generations of a bounded dictionary; what is asked for again outlives what is not."""

    def __init__(self, most: int | None = None):
        self.most = REMEMBERED if most is None else most
        self.now: dict = {}
        self.older: dict = {}

    def lacks(self, keys: Iterable[str]) -> set[str]:
        """The keys that have no value, after those of the older generation came back."""
        keys = keys if isinstance(keys, set) else set(keys)
        new = keys.difference(self.now)
        if self.older and new:
            unknown = new.difference(self.older)
            older = self.older
            self.now.update([(k, older[k]) for k in new.difference(unknown)])
            new = unknown
        return new

    def turn(self) -> None:
        if len(self.now) > self.most:
            self.older, self.now = self.now, {}

    def forget(self) -> None:
        self.now, self.older = {}, {}


class ChunkTokenizer:
    """Token ids (little-endian uint32 bytes), or counts of them, for whole texts."""

    def __init__(self, path: str, keeps_space: bool, counts: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.blank = " " if keeps_space else ""
        self.split = spaced_chunks if keeps_space else plain_chunks
        self.lower = not keeps_space  # the tokenizer that drops white space lower-cases as well
        self.model, self.byte_chars = self.tokenizer.model, byte_chars()
        self.counts = counts
        self.total = sum if counts else b"".join
        self.none = 0 if counts else b""
        self.known = Memory()  # of words, of marks around them, and of chunks that hold both

    def _encode(self, parts: list[str]) -> None:
        """Parts that are not single words, through the whole tokenizer."""
        value = (lambda e: len(e.ids)) if self.counts else (lambda e: array("I", e.ids).tobytes())
        for at in range(0, len(parts), 4096):
            some = parts[at : at + 4096]
            self.known.now.update(zip(some, map(value, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)), strict=True))

    def _encode_words(self, words: list[str]) -> None:
        """Single words are pre-tokens already: the tokenizer's model takes them in its byte alphabet."""
        model, chars = self.model.tokenize, self.byte_chars
        as_model = (w if w.isascii() and w[0] != " " else w.encode().decode("latin-1").translate(chars) for w in words)
        if self.counts:
            self.known.now.update((w, len(model(x))) for w, x in zip(words, as_model, strict=True))
        else:
            self.known.now.update((w, array("I", [t.id for t in model(x)]).tobytes()) for w, x in zip(words, as_model, strict=True))

    def _learn(self, chunks: set[str]) -> None:
        """Values of new chunks: those of the marks before a word, of the word and of the marks after it, put together."""
        plain, words, rest, parts = [], set(), set(), []
        match, blank, lower = _word.match, self.blank, self.lower
        for chunk in chunks:
            head = blank if chunk[:1] == " " else ""
            body = chunk[1:] if head else chunk
            if body.isalpha() and body.isascii() and (not lower or body.islower()):  # a word alone
                plain.append(chunk)
                continue
            m = match(body)
            if m is None or "<|" in body:
                rest.add(chunk)
                continue
            before, word, after = m.groups()
            if lower:
                word = word.lower()
            if before:
                before = head + before
                rest.add(before)
            else:
                word = head + word
            if after:
                rest.add(after)
            words.add(word)
            parts.append((chunk, before, word, after))
        self._encode_words(plain)
        self._encode_words(list(self.known.lacks(words)))
        self._encode(list(self.known.lacks(rest)))
        known = self.known.now
        known[""] = self.none
        known.update([(c, known[x] + known[y] + known[z]) for c, x, y, z in parts])

    def many(self, texts: list[str]) -> list:
        """Ids, or counts, of each text."""
        out = []
        gc.disable()  # no cycles arise here, and millions of strings would be visited in vain
        try:
            for some in together(texts, TOGETHER):
                chunked = [self.split(x) for x in some]
                self._learn(self.known.lacks(set().union(*chunked)))
                get, total = self.known.now.__getitem__, self.total
                out += [total(map(get, x)) for x in chunked]
                self.known.turn()
        finally:
            gc.enable()
        return out


def byte_chars() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


def held(path: str, keeps_space: bool, counts: bool = False) -> ChunkTokenizer:
    """The worker's own tokenizer, loaded once."""
    key = (path, keeps_space, counts)
    if key not in _held:
        _held[key] = ChunkTokenizer(*key)
    return _held[key]


def plain_chunks(text: str) -> list[str]:
    """For tokenizers that lower-case and drop white space: parts between blanks and line ends.

    A-Z are lowered here, so that fewer parts are distinct, but for texts that may hold special tokens.
    """
    if "<|" not in text:
        text = text.encode().lower().decode()
    return text.replace("\n", " ").split(" ")


def spaced_chunks(text: str) -> list[str]:
    """For byte-level tokenizers: every chunk but the first starts with white space.

    A blank between two characters of which not both are white space starts a
    chunk; texts with other runs of white space are cut before each run.
    """
    if _awkward.search(text):
        return _runs.findall(text)
    first, *rest = text.split(" ")
    return [first, *[" " + x for x in rest]]
