"""Page ranges: planning, gaps, overlaps, points in intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumine.schemas import BACK_MATTER


def with_ends(starts: DataFrame, by: list[str], start: str, last: Column) -> DataFrame:
    """Ranges that end before the next one starts; the last one ends at ``last``."""
    following = F.lead(start).over(Window.partitionBy(*by).orderBy(start))
    return starts.withColumn("end", F.coalesce(following - 1, last))


def overlaps(ranges: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """Ranges that start before an earlier one has ended."""
    before = Window.partitionBy(*by).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    return ranges.withColumn("reached", F.max(end).over(before)).where(F.col("reached") >= F.col(start))


def islands(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Runs of consecutive values: first, last and length."""
    distinct = df.select(*by, value).distinct()
    run = F.col(value) - F.row_number().over(Window.partitionBy(*by).orderBy(value))
    return distinct.withColumn("_run", run).groupBy(*by, "_run").agg(F.min(value).alias("first"), F.max(value).alias("last"), F.count("*").alias("n")).drop("_run")


def island_labels(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """``1-3_7`` for each group."""
    part = F.when(F.col("first") == F.col("last"), F.col("first").cast("string")).otherwise(F.concat_ws("-", "first", "last"))
    ordered = F.array_sort(F.collect_list(F.struct("first", part.alias("part"))))
    return islands(df, by, value).groupBy(*by).agg(F.array_join(F.transform(ordered, lambda x: x["part"]), "_").alias("label"))


def containing(points: DataFrame, starts: DataFrame, by: list[str], point: str, start: str, name: str) -> DataFrame:
    """Each point with the name of the range that it lies in.

    Ranges of a group follow one another, so that is the last one to start at
    or before the point: a window over both, no inequality join.
    """
    a = starts.select(*by, F.col(start).alias("_at"), F.lit(0).alias("_kind"), F.col(name).alias("_name"), *[F.lit(None).cast(points.schema[c].dataType).alias(c) for c in points.columns if c not in by])
    b = points.select(*by, F.col(point).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(starts.schema[name].dataType).alias("_name"), *[c for c in points.columns if c not in by])
    seen = Window.partitionBy(*by).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = a.unionByName(b).withColumn(name, F.last("_name", True).over(seen))
    return both.where(F.col("_kind") == 1).select(*points.columns, name)


def page_tasks(tasks: DataFrame) -> DataFrame:
    """Page to task; raises where two tasks claim a page."""
    pages = tasks.select("task_id", F.explode(F.sequence("pdf_start_page", "pdf_end_page")).alias("page"))
    claims = F.count("*").over(Window.partitionBy("page"))
    clash = F.raise_error(F.concat(F.lit("page in two tasks: "), F.col("page").cast("string")))
    return pages.withColumn("task_id", F.when(claims == 1, F.col("task_id")).otherwise(clash))


def book_plan(toc: DataFrame, exclude_preliminary: bool = True, exclude_back_matter: bool = True) -> DataFrame:
    """Ranges of each book (rows: book, pdf_page_count, printed_to_pdf_offset, entries).

    ``book, seq, task_id, kind, title, pdf_start_page, pdf_end_page, sections, excluded``:
    front matter up to the first chapter, chapters up to the next one, the last
    up to the back matter; what lies before and after is excluded, or a task.
    """
    offset, pages = F.col("printed_to_pdf_offset"), F.col("pdf_page_count")
    entries = toc.select("book", offset.alias("offset"), pages.alias("pages"), F.posexplode("entries").alias("pos", "e")).select("book", "offset", "pages", "pos", "e.kind", "e.title", F.col("e.printed_start_page").alias("printed"))
    entries = entries.withColumn("start", F.col("printed") + F.col("offset"))
    chapters = entries.where("kind = 'chapter'")
    extent = chapters.groupBy("book").agg(F.min("printed").alias("first_chapter"), F.max("printed").alias("last_chapter"))
    marked = entries.join(extent, "book")
    back = marked.where(F.col("kind").isin(BACK_MATTER) & (F.col("printed") > F.col("last_chapter"))).groupBy("book").agg(F.min_by(F.struct("kind", "title", "start"), "pos").alias("back"))
    bounds = extent.join(back, "book", "left").join(entries.groupBy("book").agg(F.first("pages").alias("pages"), F.first("offset").alias("offset")), "book")
    stop = F.when(F.lit(exclude_back_matter) & F.col("back").isNotNull(), F.col("back.start") - 1).otherwise(F.col("pages"))
    bounds = bounds.withColumn("stop", stop)

    front = marked.where((F.col("kind") == "front_matter") & (F.col("printed") < F.col("first_chapter"))).groupBy("book").agg(F.min_by("start", "pos").alias("pdf_start_page"))
    none = F.array().cast("array<string>")
    front = front.join(bounds, "book").select("book", F.lit(0).alias("seq"), F.lit("front-matter").alias("task_id"), F.lit("front_matter").alias("kind"), F.lit("Front Matter").alias("title"), "pdf_start_page", (F.col("first_chapter") + F.col("offset") - 1).alias("pdf_end_page"), none.alias("sections"), F.lit(False).alias("excluded"))

    order = Window.partitionBy("book").orderBy("pos")
    numbered = chapters.join(bounds.select("book", "stop"), "book").withColumn("seq", F.row_number().over(order)).withColumn("pdf_end_page", F.coalesce(F.lead("start").over(order) - 1, F.col("stop")))
    parts = entries.where("kind = 'section'").select("book", F.col("start").alias("_start"), F.col("title").alias("_title"), F.col("pos").alias("_pos"))
    inside = numbered.join(parts, "book", "left").where(F.col("_start").isNull() | F.col("_start").between(F.col("start"), F.col("pdf_end_page")))
    held = inside.groupBy("book", "seq").agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("_pos").isNotNull(), F.struct("_pos", "_title")))), lambda x: x["_title"]).alias("sections"))
    numbered = numbered.join(held, ["book", "seq"], "left").select("book", "seq", F.format_string("chapter-%02d", "seq").alias("task_id"), "kind", "title", F.col("start").alias("pdf_start_page"), "pdf_end_page", F.coalesce("sections", none).alias("sections"), F.lit(False).alias("excluded"))

    tasks = front.unionByName(numbered)
    opening = tasks.groupBy("book").agg(F.min("pdf_start_page").alias("begin")).where("begin > 1")
    opening = opening.select("book", F.lit(-1).alias("seq"), F.lit("preliminary").alias("task_id"), F.lit("preliminary").alias("kind"), F.lit("Preliminary pages").alias("title"), F.lit(1).alias("pdf_start_page"), (F.col("begin") - 1).alias("pdf_end_page"), none.alias("sections"), F.lit(exclude_preliminary).alias("excluded"))
    closing = bounds.where(F.col("back").isNotNull() & F.lit(exclude_back_matter)).select("book", F.lit(1 << 20).alias("seq"), F.col("back.kind").alias("task_id"), "back.kind", "back.title", F.col("back.start").alias("pdf_start_page"), F.col("pages").alias("pdf_end_page"), none.alias("sections"), F.lit(True).alias("excluded"))
    return tasks.unionByName(opening).unionByName(closing)


def plan_violations(plan: DataFrame, toc: DataFrame) -> DataFrame:
    """Ranges outside the book, reversed, or overlapping."""
    pages = toc.select("book", "pdf_page_count")
    bad = plan.join(pages, "book").where("NOT (1 <= pdf_start_page AND pdf_start_page <= pdf_end_page AND pdf_end_page <= pdf_page_count)")
    return bad.select("book", "task_id", F.lit("range").alias("violation")).unionByName(overlaps(plan, ["book"], "pdf_start_page", "pdf_end_page").select("book", "task_id", F.lit("overlap").alias("violation")))
