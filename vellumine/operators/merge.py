"""Merges of versions: keyed joins, upserts, overrides, set comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumine import schemas
from vellumine.functions import text as T
from vellumine.functions.text import stripped
from vellumine.operators import rules


def upsert(existing: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows whose key has no update, and the updates."""
    return existing.join(updates.select(*keys), keys, "left_anti").unionByName(updates)


def missing(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Expected keys without a row."""
    return expected.select(*keys).distinct().join(present, keys, "left_anti")


def expected_pages(tasks: DataFrame) -> DataFrame:
    """Each page of each task's range."""
    return tasks.select("task_id", F.explode(F.sequence("pdf_start_page", "pdf_end_page")).alias("page"))


def missing_report(pages: DataFrame, tables: list[DataFrame], shown: int = 30) -> DataFrame:
    """One row: the first missing pages and whether there are more."""
    lacking = None
    for table in tables:
        some = missing(pages, table, ["page"])
        lacking = some if lacking is None else lacking.union(some)
    first = lacking.distinct().orderBy("page").limit(shown + 1).agg(F.array_sort(F.collect_list("page")).alias("pages"))
    return first.select(F.slice("pages", 1, shown).alias("pages"), (F.size("pages") > shown).alias("more"))


def translated(regions: DataFrame, translations: DataFrame) -> DataFrame:
    """Regions (page, pos, id, source_text) with their translation ('' where none) and whether it grew suspiciously."""
    out = regions.join(translations, ["page", "id"], "left").withColumn("translation", F.coalesce("translation", F.lit("")))
    return out.withColumn("suspicious_expansion", T.suspicious_expansion(F.col("source_text"), F.col("translation")))


def translation_reasons(regions: DataFrame, translations: DataFrame) -> DataFrame:
    """``page, reasons``: id sets that differ, and suspicious growth."""
    ids = lambda df, name: df.groupBy("page").agg(F.array_sort(F.collect_set("id")).alias(name))
    grown = translated(regions, translations).groupBy("page").agg(F.bool_or("suspicious_expansion").alias("grown"))
    both = ids(regions, "asked").join(ids(translations, "given"), "page", "left").join(grown, "page")
    return both.select("page", rules.flags({"translation_id_mismatch": F.coalesce(F.col("asked") != F.col("given"), F.lit(True)), "translation_suspicious_expansion": F.col("grown")}).alias("reasons"))


def decided(regions: DataFrame, decisions: DataFrame) -> DataFrame:
    """Regions with decisions applied by (page, id): replace and normalize set the text, discard keeps it."""
    chosen = decisions.select("page", "id", "decision", "final_translation", "reason")
    out = regions.join(chosen, ["page", "id"], "left")
    changed = F.col("decision").isin("replace", "normalize")
    return out.withColumn("translation", F.when(changed, F.col("final_translation")).otherwise(F.col("translation")))


def decision_violations(regions: DataFrame, decisions: DataFrame, older: bool = False) -> DataFrame:
    """``page, id, violation`` of decisions that may not be applied; the older format has decisions that change nothing."""
    repeated = decisions.groupBy("page", "id").agg(F.count("*").alias("n")).where("n > 1").select("page", "id", F.lit("duplicate").alias("violation"))
    unknown = decisions.join(regions, ["page", "id"], "left_anti").select("page", "id", F.lit("unknown").alias("violation"))
    known = decisions.join(regions.select("page", "id", "translation"), ["page", "id"])
    same = F.col("final_translation") == F.col("translation")
    wrong = rules.first_of(
        {
            "blank": F.trim(F.coalesce("final_translation", F.lit(""))) == "",
            "unchanged": F.lit(not older) & F.col("decision").isin(schemas.DECISIONS) & same,
            "discard changes text": (F.col("decision") == "discard") & ~same,
            "bad decision": ~F.coalesce(F.col("decision").isin(schemas.OLDER_DECISIONS), F.lit(False)),
        }
    )
    return repeated.unionByName(unknown).unionByName(known.select("page", "id", wrong.alias("violation")).where("violation IS NOT NULL"))


def locked_snapshot(regions: DataFrame, decisions: DataFrame, overrides: DataFrame) -> DataFrame:
    """Final text of each region: a human override, else a decision, else the saved text; trimmed.

    A region without a decision has the decision ``unchanged``; the reason is
    that of what decided, and empty where none is given.
    """
    text = lambda c: stripped(F.coalesce(c, F.lit("")))
    people = overrides.select("page", "id", text(F.col("final_translation")).alias("_human"), text(F.col("reason")).alias("_human_reason"))
    reviews = decisions.select("page", "id", "decision", F.col("final_translation").alias("_reviewed"), "reason", "child_note")
    out = regions.join(reviews, ["page", "id"], "left").join(people, ["page", "id"], "left")
    source = F.when(F.col("_human").isNotNull(), "human_override").when(F.col("decision").isNotNull(), "codex_adjudication").otherwise("saved_page_translation")
    out = out.withColumn("final_translation", F.coalesce("_human", text(F.coalesce("_reviewed", "translation")))).withColumn("translation_source", source)
    reason, note = F.coalesce("_human_reason", text(F.col("reason"))), text(F.col("child_note"))
    kind, decision = F.coalesce("type", F.lit("other")), F.coalesce("decision", F.lit("unchanged"))
    return out.select("page", "id", kind.alias("type"), "source_text", "final_translation", "translation_source", decision.alias("decision"), reason.alias("reason"), note.alias("child_note"), F.lit(True).alias("locked"))


def set_overlap(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """One row: keys in both, on the left only, on the right only."""
    a, b = (df.select(*keys).distinct().withColumn(n, F.lit(True)) for df, n in ((left, "_a"), (right, "_b")))
    both = a.join(b, keys, "full")
    return both.agg(
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("overlap"),
        F.count_if(F.col("_b").isNull()).alias("left_only"),
        F.count_if(F.col("_a").isNull()).alias("right_only"),
    )


def pairwise_overlap(findings: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """For each two names: number of common keys, and of each one's.

    Pairs that share nothing are listed too; the names are few, the keys meet by an equi-join.
    """
    own = findings.select(name, *keys).distinct()
    sizes = own.groupBy(name).agg(F.count("*").alias("n"))
    common = own.withColumnRenamed(name, "a").join(own.withColumnRenamed(name, "b"), keys).where("a < b").groupBy("a", "b").agg(F.count("*").alias("overlap"))
    names = sizes.select(F.col(name).alias("a"), F.col("n").alias("left_n"))
    others = sizes.select(F.col(name).alias("b"), F.col("n").alias("right_n"))
    pairs = names.join(others, F.col("a") < F.col("b"))
    return pairs.join(common, ["a", "b"], "left").select("a", "b", "left_n", "right_n", F.coalesce("overlap", F.lit(0)).alias("overlap"))


def two_pass(first: DataFrame, second: DataFrame, asked: DataFrame, order: DataFrame) -> DataFrame:
    """Rows of a first pass, those of a second instead for the ids that asked for it, in the regions' order."""
    kept = first.join(asked.select("id"), "id", "left_anti").unionByName(second)
    return kept.join(order.select("id", "pos"), "id").orderBy("pos").drop("pos")


def first_wins(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """The first row of each key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(pos))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def paired(left: DataFrame, right: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """The k-th left row of a key with its k-th right row, only where there are as many on the right."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(pos))
    size = F.count("*").over(Window.partitionBy(*keys))
    a = left.select(*keys, F.col(pos).alias("left_pos"), number.alias("k"), size.alias("left_n"))
    b = right.select(*keys, F.col(pos).alias("right_pos"), number.alias("k"), size.alias("right_n"))
    return a.join(b, [*keys, "k"]).where("right_n >= left_n").select(*keys, "k", "left_pos", "right_pos")
