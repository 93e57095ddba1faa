"""Similarity join of documents by their word shingles, through groups and bounds.

Two documents link where the Jaccard similarity of their shingle sets reaches
``t``; the result names each document's connected component.  No link between
different sets is lost, and pairs within a group are never listed:

1. Equal sets become one class, named by its least id.
2. All sets are ordered alike: shingles in frequent slots of a fixed-size
   count sketch come last, others by hash.  Of a set of ``n`` only the first
   ``n - ceil(t n) + 1`` can be the first that a linked set shares (prefix
   filter).  The token matrix has a row for each such shingle and class, as
   far as another class has the shingle too, with its place in that order.
   Classes that share too few with classes of any size near their own leave it.
3. Groups: classes take the least class of a shingle for their leader, and
   one of them, verified, joins the leader's group.
4. A group's unions are its rows of the matrix, one union for each band of
   sizes.  A class of another group shares a count of shingles with a union;
   the count plus what lies beyond the prefix bounds the overlap with every
   member.  Where the bound reaches what a link needs, the class is verified
   against some of the members; a group of one is done with that.
5. Groups that still qualify, and whose component is another one still, are
   bounded by the union of their members' whole sets.  Those that qualify even
   then are opened: a link leaves so few of the class's shingles out that a
   linked member holds one of those that are rarest in the group, so members
   with one of these are verified on whole sets.

Whole sets are read again from the texts, only for classes that stay in the
matrix: a Bloom filter passes over the others before anything moves, and the
sets are stored in buckets by class, so that verifying moves the pairs and not
the sets.

Classes in one group are linked already, so a group of thousands of near
copies costs one verification for each of them.  Verified pairs, groups and
components stay in tables; the driver gets counts, a bit for each slot of the
sketch, and the Bloom filter.  Both have a size at most, and decide how much
work is done, never what is linked.

Defined results: a null or wordless text has an empty set and links with
nothing; a row without an id links with nothing and has no component; rows
with one id are one document; repeated rows are answered each; an empty table
gives no rows; extra columns are ignored by ``link_documents`` and kept by
``keep_one``, whatever their names.  A very long text is read in stretches (see
``shingles``); its set counts as a row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumine.llm._shared import by_bytes, cut, free_name, frugal, new_dir
from vellumine.llm.shingles import mixed, shingle_sets

#: Slots of the sketch that tells frequent shingles (a power of two), and slices in which arrays are combined.
SLOTS, SLICES = 1 << 22, 64
#: Bits of the Bloom filter for each class in it, and their number at most (a power of two).
FILTER_BITS, MOST_BITS = 16, 1 << 27
#: Members of a group that a class is verified against before the group is opened.
WITNESSES = 6
#: Sizes within a factor of 1.03 are one size band.
BAND = 1.03
#: Parts of the rows of a frequent shingle.
PARTS = 64

_CLASSED = "doc_id long, n long, digest binary, slice int, sketch binary"


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Ids, sets one after another, and their offsets, for some bytes of text at a time."""
    for some in by_bytes(batch, 1):
        yield some.column(0), *shingle_sets(some.column(1).to_pylist())


def _slots(values: np.ndarray) -> np.ndarray:
    return (values & np.uint64(SLOTS - 1)).astype(np.int64)


def _classed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and digest of each set; at the end the slices of the sketch of all."""
    import xxhash

    sketch = np.zeros(SLOTS, np.uint32)
    waiting: list[np.ndarray] = []
    names = ["doc_id", "n", "digest", "slice", "sketch"]

    def count() -> None:
        np.add(sketch, np.bincount(np.concatenate(waiting), minlength=SLOTS), out=sketch, casting="unsafe")
        waiting.clear()

    for batch in batches:
        for ids, values, offsets in _sets(batch):
            waiting.append(_slots(values))
            if sum(map(len, waiting)) > SLOTS // 4:
                count()
            digests = [xxhash.xxh3_128_digest(values[a:b].tobytes()) if b > a else None for a, b in zip(offsets, offsets[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(offsets)), pa.array(digests, pa.binary()), pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.binary())], names)
    if waiting:
        count()
    if sketch.any():
        none = [pa.nulls(SLICES, t) for t in (pa.int64(), pa.int64(), pa.binary())]
        yield pa.RecordBatch.from_arrays([*none, pa.array(np.arange(SLICES, dtype=np.int32)), pa.array([_packed(x) for x in sketch.reshape(SLICES, -1)], pa.binary())], names)


def _packed(array: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(array.astype("<u4").tobytes())


def _unpacked(packed: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "<u4")


_SLICED = "slice int, bits binary"


def _summed(least: float):
    """Each slice's sum over all tasks, as bits: which slots hold ``least`` shingles."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total[k] = total.get(k, 0) + _unpacked(packed).astype(np.uint64)
        yield from _bit_rows({k: x >= least for k, x in total.items()})

    return run


def _bit_rows(found: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([np.packbits(x).tobytes() for x in found.values()], pa.binary())], ["slice", "bits"])


def _all_bits(rows: DataFrame, size: int) -> np.ndarray:
    """Packed bits of all slices, one after another."""
    out = np.zeros((SLICES, size // SLICES // 8), np.uint8)
    for r in rows.collect():
        out[r.slice] = np.frombuffer(r.bits, np.uint8)
    return out.ravel()


def _frequent(classed: DataFrame) -> np.ndarray:
    """Slots that hold markedly more than an even share: those of frequent shingles.  The driver gets a bit for each."""
    mean = (classed.agg(F.sum("n").alias("n")).first().n or 0) / SLOTS
    slices = classed.where(F.col("slice").isNotNull()).select("slice", "sketch").repartition(SLICES, "slice")
    return np.unpackbits(_all_bits(slices.mapInArrow(_summed(mean + max(24.0, 6 * mean**0.5)), _SLICED), SLOTS)).view(bool)


def _places(ids: np.ndarray, size: int) -> list[np.ndarray]:
    """Bits of the filter that an id sets."""
    h = mixed(ids.astype(np.int64).view(np.uint64))
    return [((h >> np.uint64(k)) & np.uint64(size - 1)).astype(np.int64) for k in (0, 32)]


def _placed(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(_places(batch.column(0).to_numpy(), size))
            width = size // SLICES
            yield pa.RecordBatch.from_arrays([pa.array((at // width).astype(np.int32)), pa.array(at % width)], ["slice", "at"])

    return run


def _set_bits(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            of, at = (c.to_numpy() for c in batch.columns)
            for k in np.unique(of).tolist():
                found.setdefault(k, np.zeros(size // SLICES, bool))[at[of == k]] = True
        yield from _bit_rows(found)

    return run


def _filter(able: DataFrame) -> tuple[np.ndarray, int]:
    """Bloom filter of the column ``rep``: packed bits, and their number."""
    size = 1 << 20
    while size < min(MOST_BITS, FILTER_BITS * able.count()):
        size *= 2
    rows = able.mapInArrow(_placed(size), "slice int, at long").repartition(SLICES, "slice")
    return _all_bits(rows.mapInArrow(_set_bits(size), _SLICED), size), size


def _prefixes(frequent, num: int, den: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = frequent.value
        for batch in batches:
            for ids, values, offsets in _sets(batch):
                is_late = late[_slots(values)]
                parts, early = [], []
                for a, b in zip(offsets.tolist(), offsets[1:].tolist(), strict=False):
                    own, f = values[a:b], is_late[a:b]
                    k = b - a + (-num * (b - a)) // den + 1 if b > a else 0
                    parts.append((np.concatenate((own[~f], own[f])) if f.any() else own)[:k])
                    early.append(min(k, b - a - int(f.sum())))
                sizes = [len(p) for p in parts]
                tokens = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(np.concatenate(parts).view(np.int64)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(offsets).astype(np.int32)), pa.array(early, pa.int32()), tokens], ["rep", "n", "early", "tokens"])

    return run


def _whole(passed, size: int):
    """Sets of the documents that the Bloom filter passes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = passed.value
        for batch in batches:
            test = [bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 for at in _places(batch.column(0).to_numpy(), size)]
            for ids, values, offsets in _sets(batch.filter(pa.array((test[0] & test[1]).astype(bool)))):
                yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))], ["rep", "tokens"])

    return run


def _bucketed(df: DataFrame, by: str, name: str) -> tuple[DataFrame, str]:
    """Like ``cut``, in buckets: joins on ``by`` do not move these rows.  The catalog holds the table under the name that is returned."""
    spark = df.sparkSession
    uri = new_dir(spark, name)
    table = uri.rpartition("/")[2].replace("-", "_")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A file for each bucket.  Hashes don't compress, and a row can be large: pages are measured after every row.
    plain = {"path": uri, "compression": "none", "parquet.enable.dictionary": "false", "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "50"}
    df.repartition(n, by).write.bucketBy(n, by).sortBy(by).options(**plain).saveAsTable(table)
    return spark.table(table), table


def components(edges: DataFrame) -> DataFrame:
    """``rep, label``: the least node that each node of ``edges`` (a, b) reaches.

    Labels fall to the least of the neighbours' and then to their label's own
    label, until none changes; every step is a table in the shared folder.
    """
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "rep"), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["rep"]).groupBy("a").agg(F.min("label").alias("near"))
        moved = labels.join(near, labels["rep"] == near["a"], "left").select("rep", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        ahead = labels.select(F.col("rep").alias("via"), F.col("label").alias("further"))
        moved = cut(moved.join(ahead, F.col("label") == F.col("via"), "left").select("rep", F.least("label", "further").alias("label"), "old"), "labels")
        labels = moved.select("rep", "label")
        if moved.where(F.col("label") != F.col("old")).isEmpty():
            return labels


def _needed(a, b, num: int, den: int):
    """Least overlap of linked sets with sizes a and b: t / (1 + t) of both together."""
    return F.ceil((a + b) * F.lit(num) / F.lit(num + den) - F.lit(1e-9))


def _beyond(n, num: int, den: int):
    """Shingles beyond the prefix."""
    return F.ceil(n * F.lit(num) / F.lit(den) - F.lit(1e-9)) - 1


def _possible(c, low, high, num: int, den: int):
    """Whether a set that shares ``c`` prefix shingles can link with a set of a size from ``low`` to ``high``.

    What a link needs beyond the two prefixes is least at one end of the sizes that can link at all.
    """
    n = F.col("n")
    low, high = F.greatest(low, F.ceil(n * num / den - 1e-9)), F.least(high, F.floor(n * den / num + 1e-9))
    lacks = lambda m: _needed(n, m, num, den) - _beyond(F.greatest(n, m), num, den)
    return (low <= high) & (c >= F.least(lacks(low), lacks(high)) - 1)


def _reach(num: int, den: int) -> int:
    """Bands up to the largest linked size."""
    return int(np.ceil(np.log(den / num) / np.log(BAND))) + 1


def link_documents(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    spark = docs.sparkSession
    num, den = percent, 100
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    classed = cut(texts.mapInArrow(frugal(_classed), _CLASSED), "jaccard-classes")
    frequent = spark.sparkContext.broadcast(_frequent(classed))
    classes = rows_of(classed).where("doc_id IS NOT NULL AND n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"))

    # The token matrix: class, size, and the shingle's place in the class's order.
    named = texts.where("doc_id IS NOT NULL")
    prefixes = named.mapInArrow(frugal(_prefixes(frequent, num, den)), "rep long, n int, early int, tokens array<long>")
    prefixes = prefixes.join(classes.select("rep").distinct(), "rep", "left_semi")
    rows = prefixes.select("rep", "n", "early", F.posexplode("tokens").alias("at", "token")).select("token", "rep", "n", (F.col("at") + 1).alias("pos"), (F.col("at") >= F.col("early")).alias("late"))
    # Frequent shingles are taken as shared: their rows need not meet in one task.
    sharing = F.count("*").over(Window.partitionBy("token", F.when(F.col("late"), F.pmod("rep", F.lit(PARTS))).otherwise(0)))
    matrix = cut(rows.withColumn("sharing", sharing).where((F.col("sharing") > 1) | F.col("late")).select("token", "rep", "n", "pos"), "jaccard-matrix")

    # Classes that share enough of their prefix with classes of some size to link with one.
    matrix = matrix.withColumn("band", F.floor(F.log(F.col("n")) / float(np.log(BAND))).cast("int"))
    near = matrix.groupBy("token", F.col("band").alias("other")).agg(F.count("*").alias("k"))
    seen = matrix.join(near, "token").where(F.abs(F.col("band") - F.col("other")) <= _reach(num, den))
    seen = seen.where((F.col("band") != F.col("other")) | (F.col("k") > 1)).groupBy("rep", "n", "other").agg(F.count("*").alias("c"))
    low, high = (F.pow(F.lit(BAND), F.col("other") + k) for k in (0, 1))
    able = seen.where(_possible(F.col("c"), F.ceil(low - 1e-6), F.floor(high + 1e-6), num, den)).select("rep").distinct()
    able = cut(able, "jaccard-able")
    bits, n_bits = _filter(able)
    passed = spark.sparkContext.broadcast(bits)
    sets = named.mapInArrow(frugal(_whole(passed, n_bits)), "rep long, tokens array<long>")
    sets, in_catalog = _bucketed(sets.join(able, "rep", "left_semi"), "rep", "jaccard-sets")
    matrix = cut(matrix.join(able, "rep", "left_semi"), "jaccard-matrix")

    def verified(pairs: DataFrame) -> DataFrame:
        """Of the pairs (a, b), those that link."""
        of = lambda x: sets.select(F.col("rep").alias(x), F.col("tokens").alias(f"{x}_tokens"))
        both = F.size(F.array_intersect("a_tokens", "b_tokens"))
        total = F.size("a_tokens") + F.size("b_tokens") - both
        return pairs.join(of("a"), "a").join(of("b"), "b").where(both * den >= total * num).select("a", "b")

    # Groups: each class against one leader.
    leaders = matrix.groupBy("token").agg(F.min("rep").alias("a"))
    votes = matrix.join(leaders, "token").where("rep <> a").groupBy("rep", "n", "a").agg(F.count("*").alias("c"))
    votes = votes.groupBy("rep", "n").agg(F.max(F.struct("c", -F.col("a"))).alias("best"))
    likely = F.col("best.c") * 5 * den >= F.col("n") * (den - num)  # a fifth of the prefix; what is passed over here is met below
    links = cut(verified(votes.where(likely).select((-F.col("best.col2")).alias("a"), F.col("rep").alias("b"))), "jaccard-links")
    labels = components(links)
    sizes = labels.groupBy("label").agg(F.count("*").alias("members"))
    found = labels.join(sizes, "label").select("rep", "label", "members")
    rows = matrix.join(found, "rep", "left").select("token", "rep", "n", "pos", "band", F.coalesce("label", "rep").alias("group"), F.coalesce("members", F.lit(1)).alias("members"))
    rows = cut(rows, "jaccard-grouped")

    # Unions of groups by size band, and the classes that ask them; of two groups, the members of the smaller one ask.
    union = rows.groupBy("token", "group", "band").agg(
        F.max("members").alias("size"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("pos").alias("first"), F.min_by("rep", F.xxhash64("token", "rep")).alias("witness")
    )
    several = union.groupBy("token").agg((F.min("group") < F.max("group")).alias("several")).where("several").select("token")
    union = union.join(several, "token").select("token", F.col("group").alias("other"), F.col("band").alias("of"), "size", "lo", "hi", "first", "witness")
    fits = (F.col("lo") * num <= F.col("n") * den) & (F.col("n") * num <= F.col("hi") * den)
    smaller = (F.col("members") < F.col("size")) | ((F.col("members") == F.col("size")) & (F.col("group") > F.col("other")))
    met = rows.join(union, "token").where(fits & smaller).groupBy("rep", "n", "other", "of").agg(
        F.max("size").alias("size"),
        F.count("*").alias("c"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.max("pos").alias("last"),
        F.max("first").alias("least"),
        F.slice(F.array_sort(F.collect_set("witness")), 1, WITNESSES).alias("witnesses"),
    )
    # What is left behind the last common shingle of a single class bounds the rest as well.
    alone = F.col("c") + F.least(F.col("n") - F.col("last"), F.col("hi") - F.col("least")) >= _needed(F.col("n"), F.col("lo"), num, den)
    met = met.where(_possible(F.col("c"), F.col("lo"), F.col("hi"), num, den) & ((F.col("size") > 1) | alone))
    met = cut(met.select(F.col("rep").alias("b"), F.col("other").alias("g"), "of", "size", "lo", "witnesses"), "jaccard-met")

    # Witnesses of groups that qualify; for a group of one that is all.
    witnesses = met.select(F.explode("witnesses").alias("a"), "b").distinct()
    links = links.unionByName(cut(verified(witnesses), "jaccard-links"))

    # Groups that still qualify, and are not linked by now, are bounded by the union of their whole sets.
    labels = components(links)
    own = labels.select(F.col("rep").alias("b"), F.col("label").alias("label_b"))
    its = labels.select(F.col("rep").alias("g"), F.col("label").alias("label_g"))  # a group has the name of a member
    left = met.where("size > 1").join(own, "b", "left").join(its, "g", "left").where(F.coalesce("label_b", "b") != F.coalesce("label_g", "g"))
    left = cut(left.select("b", "g", "of", "lo"), "jaccard-left")
    placed = rows.select("rep", F.col("group").alias("g"), F.col("band").alias("of")).distinct()

    def held(asked: DataFrame) -> DataFrame:
        """Shingles of the members of the groups that are asked."""
        members = placed.join(asked.select("g", "of").distinct(), ["g", "of"], "left_semi")
        return members.join(sets, "rep").select("g", "of", F.col("rep").alias("a"), F.size("tokens").alias("na"), F.explode("tokens").alias("token"))

    def asking(asked: DataFrame) -> DataFrame:
        """Shingles of the classes that ask."""
        n, least = F.size("tokens"), F.greatest(F.col("lo"), F.ceil(F.size("tokens") * num / den - 1e-9))
        return asked.join(sets, asked["b"] == sets["rep"]).select("b", "g", "of", "lo", n.alias("n"), _needed(n, least, num, den).alias("needed"), F.explode("tokens").alias("token"))

    union = held(left).select("g", "of", "token").distinct()
    shared = asking(left).join(union, ["g", "of", "token"]).groupBy("b", "g", "of", "lo", "needed").agg(F.count("*").alias("c"))
    open_ = cut(shared.where("c >= needed").select("b", "g", "of", "lo"), "jaccard-open")

    # Opened groups: a linked member lacks so few of the class's shingles that it holds one of those that are rarest in the group.
    if not open_.isEmpty():
        members = cut(held(open_), "jaccard-members")
        frequency = members.groupBy("g", "of", "token").agg(F.count("*").alias("f"))
        rarest = Window.partitionBy("b", "g", "of").orderBy("f", "token")
        probes = asking(open_).join(frequency, ["g", "of", "token"], "left").withColumn("f", F.coalesce("f", F.lit(0))).withColumn("place", F.row_number().over(rarest))
        probes = probes.where("place <= n - needed + 1 AND f > 0").select("b", "g", "of", "token", F.col("n").alias("nb"))
        fits = (F.col("na") * num <= F.col("nb") * den) & (F.col("nb") * num <= F.col("na") * den)
        pairs = probes.join(members, ["g", "of", "token"]).where(fits).select("a", "b").distinct()
        more = cut(verified(pairs.join(witnesses, ["a", "b"], "left_anti")), "jaccard-links")
        labels = components(links.unionByName(more))

    spark.sql(f"DROP TABLE IF EXISTS `{in_catalog}`")  # all pairs are verified by now
    named_classes = cut(classes.join(labels, "rep", "left").select("digest", F.coalesce("label", "rep").alias("component")), "jaccard-named")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    out = rows_of(classed).join(named_classes, "digest", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def rows_of(classed: DataFrame) -> DataFrame:
    """The documents' rows of the classed table."""
    return classed.where(F.col("slice").isNull()).select("doc_id", "n", "digest")


def keep_one(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component (the one with the least id), columns unchanged; rows without an id stay."""
    linked = link_documents(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), percent)
    kept = free_name(docs.columns, "kept")
    first = linked.where("doc_id = component_id").select(F.col("doc_id").alias(kept)).distinct()
    return docs.join(first, F.col(id_col).cast("long") == F.col(kept), "left_semi").unionByName(docs.where(F.col(id_col).isNull()))
