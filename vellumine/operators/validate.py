"""Validation as queries: each function returns the rows that break a rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumine import schemas
from vellumine.operators import rules


def strict(df: DataFrame, violations: DataFrame, what: str) -> DataFrame:
    """``df``; raises ValueError, at once, where ``violations`` has rows."""
    if n := violations.count():
        raise ValueError(f"{what}: {n} violations, such as {violations.first().asDict()}")
    return df


def bad_fields(payload: Column, allowed: list[str]) -> Column:
    """Keys of a JSON object that are not in the closed list."""
    return F.array_except(F.json_object_keys(payload), F.array(*map(F.lit, allowed)))


def page_inputs(regions: DataFrame, pages: DataFrame) -> DataFrame:
    """``page, violation``: wrong file name or mode, no regions, blank or repeated ids, blank translations."""
    named = pages.where("mode <> 'study' OR file_page <> page").select("page", F.lit("page record").alias("violation"))
    empty = pages.join(regions, "page", "left_anti").select("page", F.lit("no regions").alias("violation"))
    blank = regions.where("trim(coalesce(id, '')) = '' OR trim(coalesce(translation, '')) = ''").select("page", F.lit("blank").alias("violation"))
    again = regions.groupBy("page", "id").agg(F.count("*").alias("n")).where("n > 1").select("page", F.lit("repeated id").alias("violation"))
    return named.unionByName(empty).unionByName(blank).unionByName(again).distinct()


def requested_ids(requests: DataFrame, regions: DataFrame) -> DataFrame:
    """Requested ids (page, id) that are unknown or repeated."""
    unknown = requests.join(regions, ["page", "id"], "left_anti").select("page", "id", F.lit("unknown").alias("violation"))
    again = requests.groupBy("page", "id").agg(F.count("*").alias("n")).where("n > 1").select("page", "id", F.lit("repeated").alias("violation"))
    return unknown.unionByName(again)


def response(reviewed: DataFrame, expected: DataFrame, decisions: DataFrame, human: DataFrame) -> DataFrame:
    """A reviewer's answer: reviewed ids are exactly the expected ones; decisions are known, unique, typed and change the text."""
    ids = lambda df: df.select("page", "id")
    lacking = ids(expected).exceptAll(ids(reviewed)).withColumn("violation", F.lit("not reviewed"))
    extra = ids(reviewed).exceptAll(ids(expected)).withColumn("violation", F.lit("not asked for"))
    out = lacking.unionByName(extra)
    for name, df in (("decision", decisions), ("review item", human)):
        out = out.unionByName(df.groupBy("page", "id").agg(F.count("*").alias("n")).where("n > 1").select("page", "id", F.lit(f"repeated {name}").alias("violation")))
        out = out.unionByName(ids(df.join(expected, ["page", "id"], "left_anti")).withColumn("violation", F.lit(f"unknown {name}")))
    wrong = rules.first_of(
        {
            "bad decision": ~F.col("decision").isin(schemas.DECISIONS),
            "blank text": F.trim(F.coalesce("final_translation", F.lit(""))) == "",
            "unchanged text": F.col("final_translation") == F.col("current_translation"),
            "bad confidence": ~F.col("confidence").isin("high", "medium", "low"),
        }
    )
    return out.unionByName(decisions.select("page", "id", wrong.alias("violation")).where("violation IS NOT NULL"))


def toc(entries: DataFrame) -> DataFrame:
    """``book, pos, violation``: unknown kinds, falling page numbers, chapters out of sequence."""
    order = Window.partitionBy("book").orderBy("pos")
    chapter = F.sum((F.col("kind") == "chapter").cast("int")).over(order)
    wrong = rules.first_of(
        {
            "unknown kind": ~F.col("kind").isin(schemas.TOC_KINDS),
            "page number falls": F.lag("printed_start_page").over(order) > F.col("printed_start_page"),
            "section of another chapter": (F.col("kind") == "section") & F.col("parent_chapter_number").isNotNull() & (F.col("parent_chapter_number") != chapter),
        }
    )
    return entries.select("book", "pos", wrong.alias("violation")).where("violation IS NOT NULL")


def reviews(results: DataFrame, pages: DataFrame, tasks: DataFrame, plan_sha256: str, ignore_hashes: bool = False) -> DataFrame:
    """``page, violation`` of saved reviews against page records (page, sha256, region_ids, regions) and tasks (page, task_id)."""
    known = results.join(pages.select("page", "sha256", F.col("region_ids").alias("own_ids")), "page", "left").join(tasks.select("page", F.col("task_id").alias("planned")), "page", "left")
    hashes = F.lit(not ignore_hashes)
    wrong = rules.first_of(
        {
            "schema": F.col("schema_version") != 5,
            "unknown page": F.col("own_ids").isNull(),
            "task": ~F.col("task_id").eqNullSafe(F.col("planned")),
            "plan changed": hashes & (F.col("plan_sha256") != plan_sha256),
            "page changed": hashes & (F.col("page_sha256") != F.col("sha256")),
            "region ids": F.array_sort("region_ids") != F.array_sort("own_ids"),
            "open human review": F.size("human_review") > 0,
        }
    )
    return known.select("page", wrong.alias("violation")).where("violation IS NOT NULL")


def snapshot(regions: DataFrame, count: int) -> DataFrame:
    """A locked snapshot: the declared count, unique keys, all locked, no blank text."""
    again = regions.groupBy("page", "id").agg(F.count("*").alias("n")).where("n > 1").select("page", "id", F.lit("repeated").alias("violation"))
    wrong = rules.first_of({"not locked": ~F.coalesce("locked", F.lit(False)), "blank text": F.trim(F.coalesce("final_translation", F.lit(""))) == ""})
    rows = regions.select("page", "id", wrong.alias("violation")).where("violation IS NOT NULL")
    total = regions.agg(F.count("*").alias("n")).where(F.col("n") != count).select(F.lit(None).cast("int").alias("page"), F.lit(None).cast("string").alias("id"), F.lit("count").alias("violation"))
    return rows.unionByName(again).unionByName(total)


def plan_against_snapshot(mappings: DataFrame, regions: DataFrame) -> DataFrame:
    """Keys on one side only, and texts that differ."""
    a = mappings.select("page", "id", F.col("final_translation").alias("planned"), F.lit(True).alias("in_plan"))
    b = regions.select("page", "id", F.col("final_translation").alias("locked_text"), F.lit(True).alias("in_snapshot"))
    both = a.join(b, ["page", "id"], "full")
    wrong = rules.first_of({"not in snapshot": F.col("in_snapshot").isNull(), "not in plan": F.col("in_plan").isNull(), "other text": ~F.col("planned").eqNullSafe(F.col("locked_text"))})
    return both.select("page", "id", wrong.alias("violation")).where("violation IS NOT NULL")


def changed_files(files: DataFrame, listed: DataFrame) -> DataFrame:
    """Listed files (name, sha256) that are no bare name, have no proper digest, are missing, or changed."""
    both = listed.join(files.select("name", F.col("sha256").alias("found")), "name", "left")
    wrong = rules.first_of(
        {
            "not a bare name": F.regexp_like(F.col("name"), F.lit(r"[/\\]")) | F.col("name").isin("", ".", ".."),
            "bad digest": ~F.regexp_like(F.col("sha256"), F.lit("^[0-9a-f]{64}$")),
            "missing": F.col("found").isNull(),
            "changed": F.col("found") != F.col("sha256"),
        }
    )
    return both.select("name", wrong.alias("violation")).where("violation IS NOT NULL")


def functional_dependency(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys with more than one value."""
    return df.groupBy(*keys).agg(F.count_distinct(value).alias("n")).where("n > 1")


def severe_overlaps(boxes: DataFrame, by: str, order: str, limit: float = 0.35) -> DataFrame:
    """Pairs of a page's boxes (column ``box``) whose common area is ``limit`` of the smaller one or more."""
    from vellumine.functions import geometry as G

    a = boxes.select(by, F.col(order).alias("first_id"), F.col("box").alias("a"))
    b = boxes.select(by, F.col(order).alias("second_id"), F.col("box").alias("b"))
    pairs = a.join(b, by).where("first_id < second_id").withColumn("ratio", G.overlap_ratio(F.col("a"), F.col("b")))
    return pairs.where(F.col("ratio") >= limit).select(by, "first_id", "second_id", F.bround("ratio", 4).alias("overlap_ratio"))
