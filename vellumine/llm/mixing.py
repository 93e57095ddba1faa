"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power of an exponent,
normalised.  The exponent is found by bisection: the one whose weights have a
target entropy, or the least one (the flattest mixture) under which no source
is repeated more often than allowed.  A source's weight times the budget is
the length of its stream.  The stream is realised as permutations of blocks:
documents are dealt to blocks by a hash, each pass over the source takes its
blocks in an order of its own, and the last pass ends where the length is
reached.  ``position`` (0 to 1) interleaves the streams: sorted by it, every
stretch of the output has the target weights.

The driver sees only how many sources have each number of tokens, a table that
cannot have more rows than the square root of twice all tokens; whatever
belongs to a source is worked out in a distributed table.  The rest is
DataFrame operations; a source's cells are
summed before any window sees them, so a source that holds most rows costs no
task more than its ``CELLS`` cells or one block.

Defined results: a null source is a source; a null or empty text has no
tokens, is read with its block, and a source without tokens has weight 0 and
gives no rows; repeated rows are read each, and rows with one id follow each
other in an order that their content determines; rows without an id are dealt
to cells by their content; an empty table gives no rows; extra columns are
kept, whatever their names: a new column whose name is taken gets underscores
behind it.  A very long text is a row like others; a text that would pass the
end of its source's stream is left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumine.llm._shared import cut, free_name, local_table

#: Hash cells of a source; blocks are ranges of cells.  A source of more than CELLS * block_tokens tokens has larger blocks.
CELLS = 1 << 18
#: Up to so many sources, their table is sent to every task; larger ones are joined cell by cell.
MAX_SOURCES = 100_000


def words(text: Column) -> Column:
    """Number of runs of characters other than white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def weights(tokens: list[int], exponent: float, counts: list[int] | None = None) -> list[float]:
    """Normalised powers of the shares; a source without tokens weighs nothing.  ``counts`` says how many sources have each number of tokens."""
    most = max(tokens, default=0)
    powers = [(t / most) ** exponent if t else 0.0 for t in tokens]
    total = sum(x * n for x, n in zip(powers, counts or [1] * len(powers), strict=True))
    return [x / total for x in powers] if total else powers


def entropy(w: list[float], counts: list[int] | None = None) -> float:
    return -sum(n * x * math.log(x) for x, n in zip(w, counts or [1] * len(w), strict=True) if x > 0)


def repeats(tokens: list[int], w: list[float], budget: float | None) -> list[float]:
    """Passes over each source; without a budget, the least-read source is read once."""
    passes = [x / t if t else 0.0 for x, t in zip(w, tokens, strict=True)]
    scale = budget if budget is not None else 1 / min((x for x in passes if x), default=1.0)
    return [x * scale for x in passes]


def exponent_for(tokens: list[int], budget: float | None, target_entropy: float | None, max_repeats: float | None, counts: list[int] | None = None) -> float:
    """Bisect the exponent.

    Entropy falls as the exponent grows; so does the highest number of passes,
    down to that of an exponent of 1.  A target that no exponent reaches gives
    the nearest end of the range.
    """
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give either a target entropy or a limit of repeats")
    if target_entropy is not None:
        low, high = 0.0, 64.0
        too_flat = lambda a: entropy(weights(tokens, a, counts), counts) > target_entropy
    else:
        low, high = 0.0, 1.0
        too_flat = lambda a: max(repeats(tokens, weights(tokens, a, counts), budget), default=0.0) > max_repeats
    if not too_flat(low):
        return low
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        low, high = (middle, high) if too_flat(middle) else (low, middle)
    return high


ADDED = ("_epoch", "_n_tokens", "_start", "_position")


def _unhashable(kind: T.DataType) -> bool:
    """Whether the type holds a map or a variant, which Spark does not hash."""
    if isinstance(kind, T.StructType):
        return any(_unhashable(f.dataType) for f in kind.fields)
    return _unhashable(kind.elementType) if isinstance(kind, T.ArrayType) else isinstance(kind, (T.MapType, T.VariantType))


def mix(docs: DataFrame, budget: float | None = None, target_entropy: float | None = None, max_repeats: float | None = None, block_tokens: int = 1 << 16, seed: int = 0, id_col: str = "doc_id", source_col: str = "source", n_tokens: Column | None = None, whole_corpus: bool = False) -> DataFrame:
    """The rows of ``docs``, once for each time they are read, with ``_epoch, _n_tokens, _start, _position``.

    ``budget`` is the number of tokens of the whole mixture, or that of all
    ``docs`` with ``whole_corpus``; without either, it is the least under which
    every source is read at least once.  ``_start`` is the number of tokens
    before the copy in its source's stream.
    """
    spark = docs.sparkSession
    content = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema.fields if not _unhashable(f.dataType)])
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(id_col).alias("id"),
        content.alias("content"),
        F.col(source_col).cast("string").alias("source"),
        F.pmod(F.xxhash64(F.lit(seed), F.when(F.col(id_col).isNull(), content), F.col(id_col)), F.lit(CELLS)).cast("int").alias("cell"),
        (words(F.col("text")) if n_tokens is None else n_tokens).cast("long").alias("n"),
    )
    cells = cut(rows.groupBy("source", "cell").agg(F.sum("n").alias("tokens")), "mixing-cells")
    table = cut(cells.groupBy("source").agg(F.sum("tokens").alias("total")), "mixing-sources")
    sizes = table.groupBy("total").count().orderBy("total").collect()
    tokens, counts = [r["total"] or 0 for r in sizes], [r["count"] for r in sizes]
    if whole_corpus:
        budget = float(sum(t * n for t, n in zip(tokens, counts, strict=True)))
    w = weights(tokens, exponent_for(tokens, budget, target_entropy, max_repeats, counts), counts)
    passes = repeats(tokens, w, budget)
    # Passes within rounding of a whole number are that number.
    passes = [float(round(p)) if abs(p - round(p)) < 1e-9 else p for p in passes]
    plan = [(t, math.floor(p), int((p - math.floor(p)) * t), p * t, min(CELLS, max(1, -(-t // block_tokens)))) for t, p in zip(tokens, passes, strict=True) if p > 0]
    plan = local_table(spark, plan, "total long, whole int, rest long, length double, blocks int")
    sources = cut(table.join(plan, "total").select("source", "total", "whole", "rest", "length", "blocks"), "mixing-plan")
    few = sum(counts) <= MAX_SOURCES
    sent = F.broadcast if few else lambda df: df

    block = F.floor(F.col("cell") * F.col("blocks") / CELLS).cast("int").alias("block")
    sized = cells.join(sent(sources), cells["source"].eqNullSafe(sources["source"])).select(sources["*"], "cell", block, "tokens")
    blocks = sized.groupBy(*sources.columns, "block").agg(F.sum("tokens").alias("tokens"))
    epochs = F.explode(F.sequence(F.lit(0), F.when(F.col("rest") > 0, F.col("whole")).otherwise(F.col("whole") - 1)))
    copies = blocks.where((F.col("whole") > 0) | (F.col("rest") > 0)).withColumn("epoch", epochs)
    order = Window.partitionBy("source", "epoch").orderBy(F.xxhash64(F.lit(seed), F.col("epoch"), F.col("source"), F.col("block")), "block")
    copies = copies.withColumn("before", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("tokens"))
    limit = F.when(F.col("epoch") < F.col("whole"), F.col("total")).otherwise(F.col("rest"))
    copies = copies.withColumn("limit", limit).where(F.col("before") < F.col("limit"))
    copies = copies.select(F.col("source").alias("of"), F.col("block").alias("part"), "epoch", "total", "before", "limit", "length")

    if few:
        per_source = sources.select(F.col("source").alias("its"), "blocks")
        placed = rows.join(F.broadcast(per_source), rows["source"].eqNullSafe(F.col("its"))).select(*rows.columns, block)
    else:  # by source and cell, so that a large source is dealt to many tasks
        per_cell = sized.select(F.col("source").alias("its"), F.col("cell").alias("at"), "block")
        placed = rows.join(per_cell, rows["source"].eqNullSafe(F.col("its")) & (rows["cell"] == F.col("at"))).select(*rows.columns, "block")
    read = placed.join(copies, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("part")))
    inside = Window.partitionBy("source", "block", "epoch").orderBy(F.xxhash64(F.lit(seed), F.col("epoch"), F.col("id")), F.col("id"), "n", "content")
    read = read.withColumn("in_pass", F.col("before") + F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n"))
    read = read.where(F.col("in_pass") + F.col("n") <= F.col("limit")).withColumn("start", F.col("epoch") * F.col("total") + F.col("in_pass"))
    position = (F.col("start") + F.col("n") / 2) / F.col("length")
    new = [x.alias(free_name(docs.columns, name)) for name, x in zip(ADDED, (F.col("epoch"), F.col("n"), F.col("start"), position), strict=True)]
    return read.select("row.*", *new)
