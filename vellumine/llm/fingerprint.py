"""Document fingerprints from improbable features, in chained Bloom filters.

Every window of 64 bytes of a text is a feature.  Its rank is its rarity by
entropy: the further the window's entropy lies from that of ordinary text, the
rarer.  In each run of 64 neighbouring features the rarest (the leftmost among
equals) scores a point; features with enough points are selected.  A selected
window's hash sets five bits of a Bloom filter of 2048 bits; after 160
features a new filter is chained.  Two filters are compared by their common
bits, normalised between what chance gives and what is possible; a chain is
compared with another by the best partner of each filter of the shorter one.

All counts are integers, so a text's fingerprint depends on the text alone.

Defined results: a null text counts as empty; an empty text has the empty
fingerprint, like only to itself; a text under 64 bytes is one feature, and a
text without selected features keeps its leftmost rarest window; null ids sort
first and are one stretch, so a table should name its rows; rows with equal ids
follow each other in the order of their texts; an empty table gives no rows;
extra columns are ignored, whatever their names.  A very long text is read in
stretches; beside its bytes it takes the memory of one stretch and of its
filters, and comparing two such texts takes time as the product of their
numbers of filters.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 64
NEIGHBOURS = 64
POINTS = 16
FILTER_BYTES = 256
FEATURES = 160
HASHES = 5
#: Entropy, as thousandths of its maximum, of a window of ordinary text; windows below LEAST are no features.
TYPICAL, LEAST = 660, 100
#: Part of the way from chance to the maximum that common bits must pass.
PASSED = 0.3

#: Longer texts, in bytes, are read in stretches of so many windows.
LONG, STRETCH = 1 << 20, 1 << 18

_FAR = np.int64(1) << 60
_ENTRY = 1 + FILTER_BYTES
_SCALE = 1 << 20
_step = np.array([(c + 1) * np.log2(c + 1) - (c * np.log2(c) if c else 0) for c in range(WINDOW + 1)])
#: Growth of the sum of c * log2(c) when a byte with count c enters a window, in units of 1 / _SCALE.
_GROWTH = np.rint(_step * _SCALE).astype(np.int64)
_POWERS = np.array([pow(0x100000001B3, k, 2**64) for k in range(WINDOW)], np.uint64)


def _counts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each byte occurs among the 63 before it, and among the 63 after it."""
    before, after = np.zeros(len(x), np.uint8), np.zeros(len(x), np.uint8)
    reach, step = WINDOW - 1, 1 << 16
    for at in range(0, len(x), step):  # in stretches that stay in the cache
        own, end = x[at : at + step], min(len(x), at + step + reach)
        stretch = x[at:end]
        for lag in range(1, WINDOW):
            n = min(len(own), len(stretch) - lag)
            if n <= 0:
                break
            same = (own[:n] == stretch[lag : lag + n]).view(np.uint8)
            after[at : at + n] += same
            before[at + lag : at + lag + n] += same
    return before, after


def _ranks(x: np.ndarray) -> np.ndarray:
    """Rank of the window that starts at each byte: low is rare; LEAST's verdict is _FAR."""
    before, after = _counts(x)
    entered = np.cumsum(_GROWTH[before])
    left = np.concatenate(([0], np.cumsum(_GROWTH[after])[: len(x) - WINDOW]))
    total = entered[WINDOW - 1 :] - left
    bits = 6 * _SCALE - total // WINDOW
    entropy = np.clip(bits * 1000 // (6 * _SCALE), 0, 1000)
    return np.where(entropy < LEAST, _FAR >> 32, 1000 - np.abs(entropy - TYPICAL))


def _least(keys: np.ndarray) -> np.ndarray:
    """Minimum of each run of NEIGHBOURS keys, from prefix and suffix minima of blocks."""
    n, w = len(keys), NEIGHBOURS
    blocks = np.full(-(-(n + w) // w) * w, _FAR << 2, np.int64)
    blocks[:n] = keys
    table = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def _hashes(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of the windows that start at some bytes."""
    hashes = np.empty(len(at), np.uint64)
    view = np.lib.stride_tricks.sliding_window_view(x, WINDOW)
    for k in range(0, len(at), 4096):
        hashes[k : k + 4096] = (view[at[k : k + 4096]].astype(np.uint64) * _POWERS).sum(axis=1, dtype=np.uint64)
    hashes ^= hashes >> np.uint64(33)
    hashes *= np.uint64(0xFF51AFD7ED558CCD)
    return hashes ^ (hashes >> np.uint64(33))


def _selected(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hash of each selected window of some texts, in order."""
    pad = b"\0" * (WINDOW - 1)
    x = np.frombuffer(pad + b"".join(r.ljust(WINDOW, b"\0") + pad for r in raw if r) + pad, np.uint8)
    sizes = np.array([len(r) for r in raw], np.int64)
    padded = np.where(sizes > 0, np.maximum(sizes, WINDOW) + len(pad), 0)
    starts = len(pad) + np.concatenate(([0], np.cumsum(padded)))[:-1]
    windows = np.where(sizes > 0, np.maximum(sizes, WINDOW) - WINDOW + 1, 0)
    if not windows.any():
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    ranks = _ranks(x)
    owner = np.repeat(np.arange(len(raw)), windows)
    at = np.arange(len(owner)) + np.repeat(starts - np.concatenate(([0], np.cumsum(windows)))[:-1], windows)
    keys = np.full(len(ranks), _FAR, np.int64)
    keys[at] = (ranks[at].astype(np.int64) << 32) | at
    best = _least(keys)[at]
    points = np.bincount((best & 0xFFFFFFFF)[best < _FAR], minlength=len(ranks))[at]
    chosen = points >= POINTS
    lacking = np.flatnonzero((windows > 0) & (np.bincount(owner[chosen], minlength=len(raw)) == 0))
    if len(lacking):
        firsts = np.concatenate(([0], np.cumsum(windows)))
        for d in lacking:
            own = slice(firsts[d], firsts[d + 1])
            chosen[firsts[d] + int(np.argmin(ranks[at[own]]))] = True
    return owner[chosen], _hashes(x, at[chosen])


def _selected_of_long(raw: bytes) -> np.ndarray:
    """Hashes of the selected windows of one long text, stretch by stretch.

    A stretch is read with what its windows' neighbours need on both sides, so
    the result is that of the whole text.
    """
    out, least = [], (int(_FAR), b"")
    for begin in range(0, len(raw) - WINDOW + 1, STRETCH):
        end = min(begin + STRETCH, len(raw) - WINDOW + 1)
        first = max(0, begin - NEIGHBOURS + 1)
        x = np.frombuffer(raw, np.uint8)[first : end + NEIGHBOURS + WINDOW - 2]
        ranks = _ranks(x)
        keys = np.where(ranks < _FAR >> 32, (ranks.astype(np.int64) << 32) | np.arange(len(ranks)), _FAR)
        best = _least(keys)[: end - first]  # of the runs that begin before the stretch ends
        points = np.bincount((best & 0xFFFFFFFF)[best < _FAR], minlength=len(ranks))
        own = np.flatnonzero(points[begin - first : end - first] >= POINTS) + (begin - first)
        out.append(_hashes(x, own))
        k = begin - first + int(np.argmin(ranks[begin - first : end - first]))
        if int(ranks[k]) < least[0]:
            least = int(ranks[k]), x[k : k + WINDOW].tobytes()
    found = np.concatenate(out)
    return found if len(found) else _hashes(np.frombuffer(least[1], np.uint8), np.zeros(1, np.int64))


def fingerprints(texts: list[str]) -> list[bytes]:
    """Chains of filters: for each, its number of features and its bits."""
    raw = [t.encode() for t in texts]
    long = [d for d, r in enumerate(raw) if len(r) > LONG]
    owner, hashes = _selected([b"" if len(r) > LONG else r for r in raw])
    if long:
        more = [_selected_of_long(raw[d]) for d in long]
        owner = np.concatenate([owner, *(np.full(len(h), d) for d, h in zip(long, more, strict=True))])
        hashes = np.concatenate([hashes, *more])
        order = np.argsort(owner, kind="stable")
        owner, hashes = owner[order], hashes[order]
    out = [b""] * len(texts)
    if not len(owner):
        return out
    n = np.bincount(owner, minlength=len(texts))
    chains = -(-n // FEATURES)
    first = np.concatenate(([0], np.cumsum(chains)))
    place = np.arange(len(owner)) - np.repeat(np.concatenate(([0], np.cumsum(n)))[:-1], n)
    row = first[owner] + place // FEATURES
    bits = np.zeros((int(first[-1]), FILTER_BYTES * 8), bool)
    for k in range(HASHES):
        bits[row, ((hashes >> np.uint64(11 * k)) & np.uint64(2047)).astype(np.int64)] = True
    packed, held = np.packbits(bits, axis=1), np.bincount(row, minlength=len(bits)).astype(np.uint8)
    entries = np.concatenate((held[:, None], packed), axis=1)
    for d in np.flatnonzero(n):
        out[d] = entries[first[d] : first[d + 1]].tobytes()
    return out


def likeness(a: bytes, b: bytes) -> float:
    """Normalised overlap of two chains, 0 to 1."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    x, y = (np.frombuffer(c, np.uint8).reshape(-1, _ENTRY) for c in (a, b))
    filters, others = x[:, 1:].view(np.uint64), y[:, 1:].view(np.uint64) if y[:, 1:].flags.c_contiguous else np.ascontiguousarray(y[:, 1:]).view(np.uint64)
    nx = np.bitwise_count(filters).sum(axis=1, dtype=np.int64)[:, None]
    ny = np.bitwise_count(others).sum(axis=1, dtype=np.int64)[None, :]
    common = np.array([np.bitwise_count(others & f).sum(axis=1, dtype=np.int64) for f in filters])
    most = np.minimum(nx, ny)
    chance = nx * ny / (FILTER_BYTES * 8)
    least = chance + PASSED * (most - chance)
    score = np.clip((common - least) / np.maximum(most - least, 1e-9), 0, 1).max(axis=1)
    held = x[:, 0].astype(float)
    return float((score * held).sum() / held.sum())


def printed(chain: bytes) -> str:
    return base64.b64encode(chain).decode()


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                some = batch.slice(at, 200)
                prints = [printed(x) for x in fingerprints(some.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


NEIGHBOURS_COMPARED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NO_ID = -(2**63)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text ends, for its last quarter, in the beginning of the text of
    the next document by id; the last document is followed by the first.

    Documents are dealt to stretches of ids.  The first document of a stretch
    is also dealt to the stretch before it, so that neighbours always meet, and
    the texts move once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = rows.agg(F.percentile_approx("key", [k / n for k in range(n)], 20 * n).alias("q"), F.min("key").alias("least")).first()
    if found.least is None:
        return spark.createDataFrame([], NEIGHBOURS_COMPARED)
    borders = np.array(sorted({found.least, *found.q}), np.int64)

    @F.pandas_udf("long")
    def stretch(key: pd.Series) -> pd.Series:
        """Number of the stretch, negative (less one) where the key is its first."""
        at = np.searchsorted(borders, key.to_numpy(), "right") - 1
        return pd.Series(np.where(borders[at] == key.to_numpy(), -1 - at, at))

    last = len(borders) - 1
    s = F.col("_s")
    dealt = F.when(
        s < 0,
        F.array(F.struct((-1 - s).alias("stretch"), F.lit(False).alias("guest")), F.struct(F.when(s == -1, F.lit(last)).otherwise(-2 - s).cast("long").alias("stretch"), F.lit(True).alias("guest"))),
    ).otherwise(F.array(F.struct(s.alias("stretch"), F.lit(False).alias("guest"))))
    placed = rows.withColumn("_s", stretch("key")).select("key", "text", F.inline(dealt))
    return placed.repartition("stretch").sortWithinPartitions("stretch", "guest", "key", "text").mapInArrow(_compared, NEIGHBOURS_COMPARED)


def _compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a stretch in order, its guests at the end."""
    import hashlib

    names = [f.split()[0] for f in NEIGHBOURS_COMPARED.split(", ")]

    def put(pairs: list[tuple[int, str, str]]) -> pa.RecordBatch:
        edited = []
        for _, text, after in pairs:
            k = len(text) // 4
            edited.append(text[: len(text) - k] + after[:k])
        prints = fingerprints([p[1] for p in pairs] + [p[2] for p in pairs] + edited)
        m = len(pairs)
        own, following, changed = prints[:m], prints[m : 2 * m], prints[2 * m :]
        columns = (
            [None if p[0] == _NO_ID else p[0] for p in pairs],
            [len(p[1]) for p in pairs],
            [hashlib.sha256(e.encode()).hexdigest() for e in edited],
            [printed(x) for x in own],
            [printed(x) for x in changed],
            [likeness(x, y) for x, y in zip(own, changed, strict=True)],
            [likeness(x, y) for x, y in zip(own, following, strict=True)],
        )
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    pairs: list[tuple[int, str, str]] = []
    size, held = 0, None  # held: the row that waits for its successor
    for batch in batches:
        for key, text, stretch, guest in zip(*(batch.column(n).to_pylist() for n in ("key", "text", "stretch", "guest")), strict=True):
            if held is not None and held[2] == stretch:
                pairs.append((held[0], held[1], text))
                size += len(held[1]) + len(text)
            held = None if guest else (key, text, stretch)
            if size > 400_000 or len(pairs) >= 200:
                yield put(pairs)
                pairs, size = [], 0
    if pairs:
        yield put(pairs)
