"""Aggregations: histograms, usage, findings, checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumine.functions import text as T

USAGE = ["input_tokens", "cached_input_tokens", "cache_write_input_tokens", "output_tokens", "reasoning_output_tokens", "total_tokens", "non_cached_input_tokens"]


def histogram(df: DataFrame, value: str) -> DataFrame:
    return df.groupBy(value).agg(F.count("*").alias("n"))


def histogram_map(df: DataFrame, value: str, name: str = "counts") -> DataFrame:
    """One row: counts by value, values in order."""
    return histogram(df.where(F.col(value).isNotNull()), value).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(value, "n")))).alias(name))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def usage(raw: Column) -> Column:
    """Token counters under their names, with what was not read from a cache; null where a counter is missing or negative."""
    names = {"inputTokens": "input_tokens", "cachedInputTokens": "cached_input_tokens", "cacheWriteInputTokens": "cache_write_input_tokens", "outputTokens": "output_tokens", "reasoningOutputTokens": "reasoning_output_tokens", "totalTokens": "total_tokens"}
    values = {new: raw[old].cast("long") for old, new in names.items()}
    good = None
    for v in values.values():
        ok = v.isNotNull() & (v >= 0)
        good = ok if good is None else good & ok
    rest = F.greatest(F.lit(0), values["input_tokens"] - values["cached_input_tokens"])
    return F.when(good, F.struct(*[v.alias(n) for n, v in values.items()], rest.alias("non_cached_input_tokens")))


def usage_sums(df: DataFrame, by: list[str], columns: list[str], available: str = "available", need_all: bool = False) -> DataFrame:
    """Sums over the available rows; with ``need_all``, only for groups whose rows all are."""
    ok = F.bool_and(available) if need_all else F.bool_or(available)
    return df.groupBy(*by).agg(F.coalesce(ok, F.lit(False)).alias("available"), *[F.when(ok, F.sum(F.when(F.col(available), F.col(c)))).alias(c) for c in columns])


def last_event(df: DataFrame, by: list[str], order: list[Column], value: Column, where: Column | None = None) -> DataFrame:
    """The value of each group's last event."""
    chosen = df if where is None else df.where(where)
    return chosen.groupBy(*by).agg(F.max_by(value, F.struct(*order)).alias("last_value"))


def repeated_expressions(df: DataFrame, key: Column, pos: str) -> DataFrame:
    """Keys that occur more than once: most frequent first, then by first position."""
    return df.select(key.alias("expression"), pos).groupBy("expression").agg(F.count("*").alias("n"), F.min(pos).alias("first_pos")).where("n > 1").orderBy(F.desc("n"), "first_pos")


def name_candidates(df: DataFrame, terms: list[str], pattern: str, source: str, pos: list[str], example: str, examples: int = 3) -> DataFrame:
    """Terms that stand free in a text, whatever their case, and other names that the pattern finds.

    ``count``, all locations, and the first distinct examples (100 characters
    each) of every name.  Each text is searched for all terms in one pass.
    """
    found = [F.when(F.regexp_like(F.col(source), F.lit(rf"(?i)(?<![A-Za-z])\Q{t}\E(?![A-Za-z])")), F.lit(t)) for t in terms]
    listed = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
    matched = F.filter(F.regexp_extract_all(F.col(source), F.lit(pattern), F.lit(0)), lambda x: ~x.isin(terms) if terms else F.lit(True))
    rows = df.select(*pos, F.col(example).alias("_example"), F.posexplode(F.concat(listed, matched)).alias("_at", "name"))
    whole = F.array_sort(F.collect_list(F.struct(*pos, "_at", F.substring("_example", 1, 100).alias("text"))))
    grouped = rows.groupBy("name").agg(F.count("*").alias("n"), whole.alias("_all"))
    location = F.transform("_all", lambda x: F.concat_ws("-", *[x[p].cast("string") for p in pos]))
    return grouped.select("name", "n", location.alias("locations"), F.slice(F.array_distinct(F.transform("_all", lambda x: x["text"])), 1, examples).alias("examples"))


def spotcheck(mappings: DataFrame, count: int, disabled: bool = False) -> DataFrame:
    """Pages with the highest score of doubtful mappings, and the reasons."""
    kind, warned = F.col("confidence"), F.array_contains(F.coalesce("warnings", F.array().cast("array<string>")), "split_mapping")
    weight = F.when(kind == "missing", 8).when(kind == "low", 5).when(kind == "medium", 2).otherwise(0) + F.when(warned, 3).otherwise(0)
    reason = F.when(kind == "missing", "unmapped region").when(kind == "low", "low mapping confidence").when(kind == "medium", "medium mapping confidence")
    reasons = F.array_sort(F.array_union(F.collect_set(reason), F.collect_set(F.when(warned, "split mapping"))))
    scored = mappings.groupBy("page").agg(F.sum(weight).alias("score"), reasons.alias("reasons"))
    return scored.orderBy(F.desc("score"), "page").limit(0 if disabled else count)


def mapping_summary(mappings: DataFrame) -> DataFrame:
    """Counts by page, and a row of totals (page null)."""
    return mappings.rollup("page").agg(
        F.count("*").alias("regions"),
        F.count_if(F.col("confidence") != "missing").alias("mapped"),
        F.count_if(F.col("confidence") == "missing").alias("unmapped"),
        F.count_if(F.size("warnings") > 0).alias("warned"),
    )


def shared_items(mappings: DataFrame) -> DataFrame:
    """Layout items that several regions own, with their ids."""
    owned = mappings.select("page", "id", F.explode("layout_item_indexes").alias("item"))
    return owned.groupBy("page", "item").agg(F.array_sort(F.collect_set("id")).alias("ids"), F.count("*").alias("n")).where("n > 1").drop("n")


def checks(spark, named: Mapping[str, DataFrame]) -> DataFrame:
    """``name, passed, failures``: a check passes where its table of failures is empty."""
    out = None
    for name, failures in named.items():
        row = failures.agg(F.count("*").alias("failures")).select(F.lit(name).alias("name"), (F.col("failures") == 0).alias("passed"), "failures")
        out = row if out is None else out.unionByName(row)
    return out


def verdict(found: DataFrame) -> DataFrame:
    return found.agg(F.bool_and("passed").alias("passed"), F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("name")))).alias("failed"))


def size_mismatches(source: DataFrame, output: DataFrame) -> DataFrame:
    """Pages whose rounded sizes differ or that one side lacks."""
    a = source.select("page", F.round("width", 2).alias("w1"), F.round("height", 2).alias("h1"))
    b = output.select("page", F.round("width", 2).alias("w2"), F.round("height", 2).alias("h2"))
    return a.join(b, "page", "full").where("NOT (w1 <=> w2 AND h1 <=> h2)").select("page")


def page_context(regions: DataFrame, by: str, pos: str, label: Column, source: str, base: str = "", limit: int = 300) -> DataFrame:
    """For each region at most ``limit`` characters: what it is, then all texts of its page, nearest first.

    Each neighbour takes five characters at least (a colon, a bar and the blanks
    beside them), so those further away than ``limit / 5`` can't be reached.
    """
    reach = -(-limit // 5)
    named = regions.select(by, pos, F.col(source).alias("_source"), label.alias("_label"))
    other = named.select(F.col(by).alias("_by"), F.col(pos).alias("_pos"), F.concat(F.col("_label"), F.lit(": "), F.coalesce("_source", F.lit(""))).alias("_text"))
    near = named.join(other, (F.col(by) == F.col("_by")) & F.col("_pos").between(F.col(pos) - reach, F.col(pos) + reach))
    distance = F.abs(F.col("_pos") - F.col(pos))
    texts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(distance.alias("d"), F.col("_pos").alias("p"), F.substring("_text", 1, limit).alias("t")))), lambda x: x["t"]), " | ")
    head = base.strip()[: min(120, limit)]
    start = F.concat(F.lit(f"{head} " if head else ""), F.lit("Current region: "), F.first("_label"), F.lit(". Nearby page text: "))
    return near.groupBy(by, pos).agg(F.substring(F.concat(start, texts), 1, limit).alias("context"))


def numbers_by_group(df: DataFrame, text: str, by: str, top: int) -> DataFrame:
    """The most frequent numbers of each group, ties by token."""
    from pyspark.sql import Window

    counted = df.select(by, F.explode(T.numbers(F.col(text))).alias("token")).groupBy(by, "token").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), "token"))
    return counted.withColumn("rank", rank).where(F.col("rank") <= top)
