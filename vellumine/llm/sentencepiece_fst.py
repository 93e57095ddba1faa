"""SentencePiece encoding and decoding as a shortest path through composed transducers.

A model file compiles to three weighted transducers.

- The normaliser reads raw characters and writes normal ones: the character
  map's longest match, blanks as space marks, one mark in front of the text.
  Where runs of blanks count as one, its output is delayed: a state after
  blanks writes the mark with the next character, so blanks at the end write
  nothing.
- The piece transducer is a trie of the pieces.  The end of a piece writes it
  and goes back to the root; the state there remembers the piece just read.
  It is stored backwards, as arcs are looked up from where they end.
- The fallback has an arc for every character that no piece covers and writes
  its UTF-8 byte pieces, or the unknown piece, once for a run of them.

Inputs are composed with them from left to right, arc by arc as they are
needed; new inputs together, as a trie, so that common beginnings are composed
once.  The output of each is the path of least weight in the tropical semiring
(weights add along a path, the least sum wins, the earlier start among equals).

Weights: in a unigram model an arc weighs minus its piece's score, and a
fallback arc ten more than the heaviest piece.  In a merge (BPE) model sums of
scores do not give the library's result; there an arc that reads piece ``b`` in
the state of piece ``a`` weighs 0 where merging ``ab`` from its characters
leaves exactly ``a, b``, and infinity elsewhere.  A sequence of pieces is the
library's iff all its neighbours are such pairs, so exactly one path has a
finite weight.

No piece holds the space mark behind another character (if one does, texts are
not taken apart), so the composition falls apart before every run of blanks,
and again between two characters that stand side by side in no piece; a worker
remembers the paths of such parts, within a bound of memory.

Defined results: null is encoded as the empty text (no ids); a space mark in
the text itself decodes to a blank, as in the library; repeated rows and ids
each keep their row; an empty table gives no rows; extra columns are ignored,
whatever their names.  A very long text is encoded whole, part by part; the
memory taken beside it is that of its parts.
"""

from __future__ import annotations

import gc
import hashlib
import math
import re
import struct
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumine.llm._chunks import Memory
from vellumine.llm._shared import by_bytes, frugal, together

MARK = "▁"
#: Fixed values of the model format: kinds of models and of pieces.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: What a fallback arc weighs above the heaviest piece of a unigram model.
PENALTY = 10.0


@dataclass(frozen=True)
class Bounds:
    """Parts whose paths a worker remembers, and pairs of pieces, before it starts afresh; characters of text that are taken together."""

    remembered: int = 250_000
    pairs: int = 250_000
    together: int = 4_000_000
    #: Whether a worker keeps its transducer for its next task.
    held: bool = True


LARGE = Bounds()
#: Where executors are small, or workers have other things to do as well.
SMALL = Bounds(50_000, 50_000, 1_000_000, held=False)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol-buffer message: number and value (groups do not occur)."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value: int | bytes = varint()
        else:
            length = {1: 8, 5: 4}.get(kind) or varint()
            value = data[at : at + length]
            at += length
        yield key >> 3, value


class CharacterMap:
    """The normaliser's rules: a double-array trie of byte strings, and what each is replaced by."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = array("I", blob[4 : 4 + size])
        self.values = blob[4 + size :]

    def _below(self, node: int, byte: int) -> int | None:
        unit = self.units[node]
        at = node ^ ((unit >> 10) << ((unit & 512) >> 6)) ^ byte
        return at if at < len(self.units) and self.units[at] & 0x800000FF == byte else None

    def _value(self, node: int) -> bytes | None:
        """What the string that ends at ``node`` is replaced by; None inside a string."""
        unit = self.units[node]
        if not unit >> 8 & 1:
            return None
        at = self.units[node ^ ((unit >> 10) << ((unit & 512) >> 6))] & 0x7FFFFFFF
        return self.values[at : self.values.index(b"\0", at)]

    def longest(self, data: bytes, at: int) -> tuple[int, str] | None:
        """Length and replacement of the longest rule that matches at ``at``."""
        node, found = 0, None
        for k in range(at, len(data) if self.units else at):
            below = self._below(node, data[k])
            if below is None:
                break
            node = below
            value = self._value(node)
            if value is not None:
                found = (k + 1 - at, value.decode())
        return found

    def crosses_blanks(self) -> bool:
        """Whether a rule goes on after a blank, or reads one after a letter or digit: texts can't be cut there."""
        if not self.units:
            return False
        blank = self._below(0, 32)
        if blank is not None and any(self._below(blank, b) is not None for b in range(1, 256)):
            return True
        return any((n := self._below(0, b)) is not None and self._below(n, 32) is not None for b in range(33, 127))


class Normaliser:
    """The first transducer.  ``rewrite`` runs it over a part of a text that begins with the blanks before a word."""

    def __init__(self, rules: CharacterMap, squeeze: bool, kept: list[str]):
        self.rules, self.squeeze = rules, squeeze
        self.kept = re.compile("|".join(map(re.escape, sorted(kept, key=len, reverse=True)))) if kept else None
        self.plain = not rules.units and not kept

    def _arcs(self, text: str) -> Iterator[str]:
        """What each step over the input writes before blanks are looked at."""
        at = 0
        while at < len(text):
            m = self.kept.match(text, at) if self.kept else None
            if m and m.end() > at:
                yield m[0]
                at = m.end()
                continue
            rule = self.rules.longest(text[at : at + 64].encode(), 0)
            if rule is None:
                yield text[at]
                at += 1
            else:
                yield rule[1]
                at += len(text[at : at + 64].encode()[: rule[0]].decode(errors="ignore"))

    def rewrite(self, text: str) -> str:
        if self.plain and not self.squeeze:  # every state has the same arcs
            return text.replace(" ", MARK)
        out, waiting = [], False
        for c in text if self.plain else "".join(self._arcs(text)):
            if c != " ":
                out.append(MARK + c if waiting else c)
                waiting = False
            elif self.squeeze:
                waiting = True  # the mark is written with the next character
            else:
                out.append(MARK)
        return "".join(out)


class _Merges:
    """Weights of a merge model's arcs: which pieces stay apart."""

    def __init__(self, scores: dict[str, float], most: int):
        self.most = most
        self.marks = {len(p) for p in scores if not p.strip(MARK)}
        # Runs of marks have one score; among equal scores the leftmost pair merges first, so a longer run comes later.
        self.rank = {p: (-s, len(p) if not p.strip(MARK) else 0) for p, s in scores.items() if len(p) > 1}
        self.splits: dict[str, tuple[str, str] | None] = {}
        self.rows: dict[str, dict[str, bool]] = {"": {}}
        self.known = 0

    def _step(self, parts: list[str]) -> bool:
        """Merge the best pair, leftmost among equals."""
        best = min(((self.rank[x], k) for k in range(len(parts) - 1) if (x := parts[k] + parts[k + 1]) in self.rank), default=None)
        if best is not None:
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return best is not None

    def split(self, piece: str) -> tuple[str, str] | None:
        """The last merge that makes ``piece``; None for a character, and for what no merging makes."""
        if piece not in self.splits:
            parts = list(piece)
            while len(parts) > 2 and self._step(parts):
                pass
            made = len(piece) > 1 and len(parts) == 2 and all(len(x) == 1 or self.made(x) for x in parts)
            self.splits[piece] = (parts[0], parts[1]) if made else None
        return self.splits[piece]

    def made(self, piece: str) -> bool:
        return len(piece) == 1 or (piece in self.rank and self.split(piece) is not None)

    def _apart(self, a: str, b: str) -> bool:
        """Whether ``a, b`` stay apart: merges are undone, latest first, and none may have crossed the border."""
        if not (a.strip(MARK) or b.strip(MARK)):  # of a run of marks, the longest piece comes first
            return len(b) <= len(a) and self.marks.isdisjoint(range(len(a) + 1, len(a) + len(b) + 1))
        rank, limit = self.rank, None
        while True:
            across = rank.get(a + b)
            if across is not None and (limit is None or across < limit[0] or (across == limit[0] and limit[1])):
                return False
            ra, rb = rank.get(a), rank.get(b)
            if ra is None and rb is None:
                return True
            if rb is None or (ra is not None and ra > rb):  # a's last merge came later; at the border, its right part was there before
                limit, a = (ra, False), self.split(a)[1]
            else:  # b's last merge; an equal pair at the border stood further left and came first
                limit, b = (rb, True), self.split(b)[0]

    def finite(self, before: str, piece: str) -> bool:
        """Whether the arc that reads ``piece`` in the state of ``before`` (empty at the start) weighs 0; remembered."""
        if self.known > self.most:
            self.rows, self.known = {"": {}}, 0
        self.known += 1
        found = self.made(piece) and (not before or self._apart(before, piece))
        self.rows.setdefault(before, {})[piece] = found
        return found


class PieceTransducer:
    """A compiled model; ``encode`` and ``decode`` of single texts, ``many`` for batches."""

    def __init__(self, model: bytes, bounds: Bounds = LARGE):
        self.bounds = bounds
        pieces, trainer, normaliser = [], {}, {}
        for number, value in _fields(model):
            if number == 1:
                f = dict(_fields(value))
                score = struct.unpack("<f", f[2])[0] if 2 in f else 0.0
                pieces.append((f[1].decode(), score, f.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        kind = trainer.get(3, UNIGRAM)
        if kind not in (UNIGRAM, BPE) or trainer.get(24) or not normaliser.get(5, 1) or any(k == UNUSED for *_, k in pieces):
            raise ValueError("this compiler takes unigram and merge models that mark blanks in front of words")
        self.pieces = [p for p, *_ in pieces]
        self.unknown = next(i for i, (*_, k) in enumerate(pieces) if k == UNKNOWN)
        self.byte_of = {i: int(p[3:5], 16) for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        byte_ids = {b: i for i, b in self.byte_of.items()}
        self.skipped = {i for i, (*_, k) in enumerate(pieces) if k in (CONTROL, UNKNOWN)}
        self.printed = [trainer.get(44, " ⁇ ".encode()).decode() if i == self.unknown else "" if i in self.skipped else p for i, p in enumerate(self.pieces)]
        scores = {p: s for p, s, k in pieces if k == NORMAL}
        users = [p for p, _, k in pieces if k == USER]
        self.dummy, squeeze = bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1))
        rules = CharacterMap(normaliser.get(2) or b"")
        self.normaliser = Normaliser(rules, squeeze, users)
        self.whole = rules.crosses_blanks() or any(MARK in p.lstrip(MARK) for p in (*scores, *users)) or any(p[0] in " " + MARK for p in users)
        self.cuttable = re.compile(" (?<![^A-Za-z0-9] )") if rules.units else None  # other characters may turn into blanks

        # The piece transducer, read backwards: a node has the nodes below it, the piece that begins there, and its weight.
        self.merges = _Merges(scores, bounds.pairs) if kind == BPE else None
        self.frozen = self.normaliser.kept if kind == BPE else None
        weights = {p: 0.0 if self.merges else -s for p, s in scores.items()}
        if not self.merges:
            weights |= {p: 0.1 - len(p.encode()) * max(scores.values()) for p in users}
        self.fallback = 0.0 if self.merges else PENALTY - min(scores.values(), default=0.0)
        self.ends: dict[str, list] = {}
        for piece, weight in weights.items():
            below = self.ends
            for c in reversed(piece):
                node = below.setdefault(c, [{}, None, math.inf])
                below = node[0]
            node[1:] = [piece, weight]
        # What an arc writes: ids, packed.  Characters that no piece covers write bytes.
        self.written = {p: struct.pack("<I", i) for i, (p, _, k) in enumerate(pieces) if k in (NORMAL, USER)}
        self.byte_ids = [struct.pack("<I", byte_ids[b]) for b in range(256)] if len(byte_ids) == 256 else None
        self.unknown_id = struct.pack("<I", self.unknown)
        self.inside = {p[k : k + 2] for p in (*scores, *users) for k in range(len(p) - 1)}
        self.paths, self.normal = Memory(bounds.remembered), Memory(bounds.remembered)

    def compose(self, stretches: Iterable[str]) -> Iterator[tuple[str, list[str]]]:
        """Each stretch of normal characters, in alphabetical order, and what the arcs of its lightest path read.

        The trie of all stretches is composed with pieces and fallback: the
        state after a beginning that stretches have in common is worked out
        once.  A state keeps the least weight of the paths that lead to it and
        the last arc of the lightest one; arcs are found backwards, by the
        pieces' last characters.
        """
        weights, reads, before = [0.0], [""], ""
        ends, fallback, merges = self.ends, self.fallback, self.merges
        infinite = math.inf
        for normal in stretches:
            same, most = 0, min(len(before), len(normal))
            while same < most and before[same] == normal[same]:
                same += 1
            del weights[same + 1 :], reads[same + 1 :]
            rows = merges.rows if merges else None
            for end in range(same + 1, len(normal) + 1):
                best, read, start = infinite, "", end - 1
                c = normal[start]
                node = ends.get(c)
                if node is None or node[1] is None:  # an arc of the fallback
                    if rows is None or merges.finite(reads[start], c):
                        best, read = weights[start] + fallback, c
                while node is not None:
                    below, piece, weight = node
                    if piece is not None and (here := weights[start] + weight) <= best and here < infinite:
                        if rows is None:
                            best, read = here, piece
                        else:
                            row = rows.get(reads[start])
                            finite = None if row is None else row.get(piece)
                            if finite or (finite is None and merges.finite(reads[start], piece)):
                                best, read = here, piece
                                break  # only one path has a finite weight
                    if not start:
                        break
                    start -= 1
                    node = below.get(normal[start])
                weights.append(best)
                reads.append(read)
            at = len(normal)
            if weights[at] == infinite:
                raise ValueError("the model gives no path of finite weight")
            out = []
            while at:
                out.append(reads[at])
                at -= len(reads[at])
            before = normal
            yield normal, out[::-1]

    def _ids(self, stretches: set[str]) -> Iterator[tuple[str, bytes]]:
        """What the lightest paths write; a frozen symbol is read by one arc of its own."""
        written = self.written
        symbols = [x for x in stretches if self.frozen.fullmatch(x)] if self.frozen else []
        for normal, reads in [*((x, [x]) for x in symbols), *self.compose(sorted(stretches.difference(symbols)))]:
            try:
                yield normal, b"".join([written[x] for x in reads])
                continue
            except KeyError:
                out: list[bytes] = []
            for read in reads:
                ids = written.get(read)
                if ids is not None:
                    out.append(ids)
                elif self.byte_ids:
                    out += [self.byte_ids[b] for b in read.encode()]
                elif not out or out[-1] != self.unknown_id:  # one for a run
                    out.append(self.unknown_id)
            yield normal, b"".join(out)

    def _cuts(self, normal: str) -> list[str]:
        """``normal`` cut where two neighbours stand in no piece: there every path has a border; and around frozen symbols."""
        if self.frozen:
            return [y for x in re.split(f"({self.frozen.pattern})", normal) if x for y in ([x] if self.frozen.fullmatch(x) else self._bare_cuts(x))]
        return self._bare_cuts(normal)

    def _bare_cuts(self, normal: str) -> list[str]:
        if self.byte_ids is None:
            return [normal] if normal else []  # a run of unknown characters is one
        runs = self._runs.findall(normal)
        if len(runs) < 2:
            return runs
        inside, out = self.inside, runs[:1]
        for x in runs[1:]:
            if out[-1][-1] + x[0] in inside:
                out[-1] += x
            else:
                out.append(x)
        return out

    _runs = re.compile(f"{MARK}*[^\\W\\d_]+|.", re.DOTALL)

    def _learn(self, parts: set[str]) -> None:
        """Paths of new parts: those of their cuts, one after another."""
        cuts = [(x, self._cuts(x)) for x in parts]
        new = self.paths.lacks({y for _, c in cuts for y in c})
        paths = self.paths.now
        paths.update(list(self._ids(new)))
        paths.update([(x, b"".join([paths[y] for y in c])) for x, c in cuts if len(c) != 1])

    _marks_first = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
    _blanks_first = re.compile(" *[^ ]+| +")

    def parts(self, text: str) -> list[str]:
        """The normal text in parts that begin with a run of marks; the blank that stands for its beginning is read first."""
        if not text:
            return []
        if self.dummy:
            text = " " + text
        elif self.normaliser.squeeze:
            text = text.lstrip(" ")
        rewrite = self.normaliser.rewrite
        if self.whole:
            return [rewrite(text)]
        if self.normaliser.plain and not self.normaliser.squeeze:
            text = rewrite(text)
            if MARK * 2 in text or text[-1] == MARK or text[0] != MARK:
                return self._marks_first.findall(text)
            return [MARK + x for x in text[1:].split(MARK)]
        if self.cuttable:
            cuts = [0, *(m.start() for m in self.cuttable.finditer(text) if m.start()), len(text)]
            raw = [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        else:
            raw = self._blanks_first.findall(text)
        self.normal.now.update([(x, rewrite(x)) for x in self.normal.lacks(raw)])
        found = list(map(self.normal.now.__getitem__, raw))
        self.normal.turn()
        return self._marks_first.findall("".join(found)) if MARK in text else found

    def many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian uint32 bytes."""
        out = []
        gc.disable()  # no cycles arise here, and millions of strings would be visited in vain
        try:
            for some in together(texts, self.bounds.together):
                parts = [self.parts(x) for x in some]
                self._learn(self.paths.lacks(set().union(*parts)))
                get = self.paths.now.__getitem__
                out += [b"".join(map(get, x)) for x in parts]
                self.paths.turn()
        finally:
            gc.enable()
        return out

    def forget(self) -> None:
        """Drop the remembered paths; Spark keeps more workers waiting than it has cores."""
        self.paths.forget()
        self.normal.forget()

    def encode(self, text: str) -> list[int]:
        return array("I", self.many([text])[0]).tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """The inverse transducer: pieces to text, runs of byte pieces to UTF-8, marks to blanks."""
        ids = list(ids)
        if self.byte_of.keys().isdisjoint(ids):
            text = "".join(map(self.printed.__getitem__, ids))
        else:
            out = bytearray()
            for i in ids:
                if i in self.byte_of:
                    out.append(self.byte_of[i])
                else:
                    out += self.printed[i].encode()
            text = out.decode(errors="replace")
        text = text.replace(MARK, " ")
        return text[1:] if self.dummy and text[:1] == " " else text


_held: dict[tuple[str, Bounds], PieceTransducer] = {}


def held(path: str, bounds: Bounds = LARGE) -> PieceTransducer:
    """The transducer of a model file: the worker's own, compiled once, or one for this task alone."""
    if (path, bounds) in _held:
        return _held[path, bounds]
    with open(path, "rb") as file:
        made = PieceTransducer(file.read(), bounds)
    if bounds.held:
        _held[path, bounds] = made
    return made


ENCODED = "doc_id long, n_tokens long, ids array<int>"
DECODED = ", decoded_chars long, decoded_sha256 string"


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", bounds: Bounds = LARGE) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row."""
    return _coded(docs, model_path, id_col, text_col, False, bounds)


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row, and length and SHA-256 of the text that its ids decode to."""
    return _coded(docs, model_path, id_col, text_col, True, LARGE)


def _coded(docs: DataFrame, model_path: str, id_col: str, text_col: str, decoded: bool, bounds: Bounds) -> DataFrame:
    @frugal
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = held(model_path, bounds)
        for batch in batches:
            for some in by_bytes(batch, 1, bounds.together):
                coded = transducer.many(some.column(1).to_pylist())
                sizes = [len(x) // 4 for x in coded]
                offsets = pa.array([0, *_running(sizes)], pa.int32())
                ids = pa.ListArray.from_arrays(offsets, pa.Array.from_buffers(pa.int32(), sum(sizes), [None, pa.py_buffer(b"".join(coded))]))
                columns, names = [some.column(0), pa.array(sizes, pa.int64()), ids], ["doc_id", "n_tokens", "ids"]
                if decoded:
                    chars, digests = [], []
                    for x in coded:
                        text = transducer.decode(array("I", x))
                        chars.append(len(text))
                        digests.append(hashlib.sha256(text.encode()).hexdigest())
                    columns += [pa.array(chars, pa.int64()), pa.array(digests, pa.string())]
                    names += ["decoded_chars", "decoded_sha256"]
                yield pa.RecordBatch.from_arrays(columns, names)
        transducer.forget()
        del transducer

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, ENCODED + DECODED if decoded else ENCODED)


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, text`` of rows with ``doc_id, ids``; null ids give a null text."""

    @frugal
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = held(model_path)
        for batch in batches:
            texts = [None if x is None else transducer.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def _running(sizes: list[int]) -> Iterator[int]:
    total = 0
    for x in sizes:
        total += x
        yield total
