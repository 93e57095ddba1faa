"""A book's reviews, final texts and placements: gated joins of pages, tasks, decisions and overrides.

Gates are queries of violations (see ``validate``); a gate that is broken raises
ValueError before anything is written.  What belongs to a page stays in the
page's rows: nothing but counts and the violations shown reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumine import schemas
from vellumine.functions import geometry as G
from vellumine.functions.text import stripped
from vellumine.operators import answers, merge, reports, rules, validate

ADJUDICATION = "struct<decision:string,reason:string,confidence:string,child_note:string>"


def adjudicated(regions: DataFrame, decisions: DataFrame, human: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Regions with a chapter's decisions applied, and ``page, review_required, review_reasons`` of every page.

    Each region gets ``original_translation`` and ``adjudication`` (null without
    a decision).  Decisions of unknown regions, repeated ones, unknown kinds,
    blank texts, discards that change the text, and review items of unknown
    regions are refused.
    """
    decisions = decisions.withColumn("final_translation", stripped(F.coalesce("final_translation", F.lit(""))))
    validate.strict(decisions, merge.decision_violations(regions, decisions, older=True), "decisions")
    validate.strict(human, human.join(regions, ["page", "id"], "left_anti"), "review items of unknown regions")
    text = lambda c: stripped(F.coalesce(F.col(c), F.lit("")))
    chosen = decisions.select("page", "id", "final_translation", F.struct("decision", text("reason").alias("reason"), F.col("confidence").cast("string").alias("confidence"), text("child_note").alias("child_note")).alias("adjudication"))
    out = regions.withColumnRenamed("translation", "original_translation").join(chosen, ["page", "id"], "left")
    changed = F.col("adjudication.decision").isin(schemas.DECISIONS)
    out = out.withColumn("translation", F.when(changed, F.col("final_translation")).otherwise(F.col("original_translation"))).drop("final_translation")
    asked = human.select("page").distinct().withColumn("asked", F.lit(True))
    pages = regions.select("page").distinct().join(asked, "page", "left").select("page", F.coalesce("asked", F.lit(False)).alias("review_required"))
    return out, pages.withColumn("review_reasons", rules.flags({"codex_adjudication_needs_human": F.col("review_required")}))


def application(regions: DataFrame, human: DataFrame) -> DataFrame:
    """One row: how many decisions were applied, the changes by (page, id), and the open review items."""
    changes = regions.where("adjudication IS NOT NULL").select("page", "id", "adjudication.decision", "original_translation", F.col("translation").alias("final_translation"), "adjudication.reason", "adjudication.child_note")
    applied = changes.agg(F.count("*").alias("applied_count"), F.array_sort(F.collect_list(F.struct(*changes.columns))).alias("changes"))
    return applied.join(human.agg(F.count("*").alias("human_review_count")))


def reviewed_pages(tasks: DataFrame, pages: DataFrame, reviews: DataFrame, plan_sha256: str, ignore_hashes: bool = False) -> DataFrame:
    """``page, violation`` of every planned page: no page record, no study record, no review, or a review that ``validate.reviews`` refuses; and tasks with several threads.

    ``tasks`` (task_id, page), ``pages`` (page, mode, sha256, region_ids),
    ``reviews`` (schemas.REVIEW).
    """
    planned = tasks.select("page", "task_id")
    known = planned.join(pages.select("page", "mode"), "page", "left").join(reviews.select("page", F.lit(True).alias("reviewed")).distinct(), "page", "left")
    wrong = rules.first_of({"no page record": F.col("mode").isNull(), "not a study page": F.col("mode") != "study", "no review": F.col("reviewed").isNull()})
    out = known.select("page", wrong.alias("violation")).where("violation IS NOT NULL")
    out = out.unionByName(validate.reviews(reviews.join(planned.select("page"), "page", "left_semi"), pages, planned, plan_sha256, ignore_hashes))
    several = reviews.where("thread_id IS NOT NULL").groupBy("task_id").agg(F.count_distinct("thread_id").alias("n"), F.min("page").alias("page")).where("n > 1")
    return out.unionByName(several.select("page", F.lit("several threads in a task").alias("violation")))


def merged_reviews(tasks: DataFrame, pages: DataFrame, regions: DataFrame, reviews: DataFrame, plan_sha256: str, ignore_hashes: bool = False) -> tuple[DataFrame, DataFrame]:
    """Regions of the planned pages with the sparse decisions of their reviews, and one row about the book.

    The row has counts, all decisions with their task, the thread of each task
    and the digests of all inputs.
    """
    validate.strict(reviews, reviewed_pages(tasks, pages, reviews, plan_sha256, ignore_hashes), "book reviews")
    planned = tasks.select("page", "task_id")
    decisions = reviews.join(planned, ["page", "task_id"], "left_semi").select("task_id", "page", F.explode("decisions").alias("d")).select("task_id", "page", "d.id", "d.decision", "d.final_translation", "d.reason", "d.confidence", "d.child_note")
    validate.strict(decisions, decisions.join(regions, ["page", "id"], "left_anti"), "decisions of unknown regions")
    own = regions.join(planned.select("page"), "page", "left_semi")
    chosen = decisions.select("page", "id", "final_translation", F.struct("decision", "reason", "confidence", "child_note", F.lit("codex_book_review").alias("source")).alias("adjudication"))
    merged = own.join(chosen, ["page", "id"], "left").withColumn("translation", F.coalesce("final_translation", "translation")).drop("final_translation")

    sorted_map = lambda key, value, name: F.map_from_entries(F.array_sort(F.collect_set(F.struct(key, value)))).alias(name)
    counts = own.agg(F.count("*").alias("region_count"))
    read = planned.agg(F.array_sort(F.collect_set("page")).alias("pages")).withColumn("page_count", F.size("pages"))
    listed = decisions.agg(F.count("*").alias("decision_count"), F.array_sort(F.collect_list(F.struct("page", "id", "task_id", "decision", "final_translation", "reason", "confidence", "child_note"))).alias("decisions"))
    hashes = pages.join(planned.select("page"), "page", "left_semi").agg(sorted_map("page", "sha256", "page_record_hashes"))
    threads = reviews.join(planned, ["page", "task_id"], "left_semi").where("thread_id IS NOT NULL").agg(sorted_map("task_id", "thread_id", "persistent_threads"))
    fixed = [F.lit(1).alias("schema_version"), F.lit("codex_book_adjudication").alias("kind"), F.lit("validated_complete").alias("status"), F.lit(plan_sha256).alias("book_plan_sha256")]
    return merged, read.join(counts).join(listed).join(hashes).join(threads).select(*fixed, "*")  # tables of one row each


def final_snapshot(regions: DataFrame, overrides: DataFrame, pages: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The locked texts (schemas.SNAPSHOT) of regions whose decisions were applied, and one row of counts by source.

    Overrides are restricted to ``pages`` first, where only some pages are
    wanted; then unknown ones and blank final texts are refused.
    """
    if pages is not None:
        regions, overrides = (df.join(pages.select("page"), "page", "left_semi") for df in (regions, overrides))
    validate.strict(overrides, overrides.join(regions, ["page", "id"], "left_anti"), "overrides of unknown regions")
    decisions = regions.where("adjudication IS NOT NULL").select("page", "id", "adjudication.decision", F.col("translation").alias("final_translation"), "adjudication.reason", "adjudication.child_note")
    locked = merge.locked_snapshot(regions.drop("adjudication"), decisions, overrides)
    validate.strict(locked, locked.where("final_translation = ''"), "blank final texts")
    counts = locked.agg(F.count("*").alias("region_count"), F.count_distinct("page").alias("page_count"))
    return locked, counts.join(reports.histogram_map(locked, "translation_source", "translation_source_counts"))


def placement_plan(mappings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts of each page, and one row for the book: counts, histogram of confidence, and layout items that several regions own."""
    placed = F.col("placement_box").isNotNull() & (F.size("placement_box") > 0)
    by_page = mappings.groupBy("page").agg(F.count("*").alias("region_count"), F.count_if(placed).alias("mapped_count"), F.sum(F.size("warnings")).alias("warning_count"))
    owners = reports.shared_items(mappings)
    total = mappings.agg(F.count_distinct("page").alias("page_count"), F.count("*").alias("region_count"), F.count_if(placed).alias("mapped_count"), F.count_if(~placed).alias("unmapped_count"))
    conflicts = owners.agg(F.count("*").alias("layout_item_ownership_conflict_count"))
    return by_page, total.join(reports.histogram_map(mappings, "confidence", "confidence_counts")).join(conflicts)


# The chapter's report for reviewers, as sections of text.


def _cell(text: Column) -> Column:
    """A text inside a table's row."""
    return F.replace(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def place(page: str = "page", own: str = "id") -> Column:
    return F.concat(F.lit("p"), F.col(page).cast("string"), F.lit("-"), F.col(own))


def headings(regions: DataFrame) -> DataFrame:
    """``page, pos, place, source, translation`` of headings and entries of contents, ready for a table."""
    return regions.where(F.col("type").isin("heading", "contents")).select("page", "pos", place().alias("place"), _cell(F.col("source_text")).alias("source"), _cell(F.col("translation")).alias("translation"))


def repeated_texts(regions: DataFrame) -> DataFrame:
    """``n, first_page, source, locations, translations`` of source texts that occur more than once, white space and case apart.

    Most frequent first, then by the first page; translations are the different ones in order of occurrence.
    """
    key = F.regexp_replace(F.lower(stripped(F.col("source_text"))), r"(?U)\s+", " ")
    ordered = F.array_sort(F.collect_list(F.struct("page", "pos", "id", "source_text", "translation")))
    found = regions.groupBy(key.alias("key")).agg(F.count("*").alias("n"), ordered.alias("rows")).where("n > 1")
    locations = F.array_join(F.transform("rows", lambda r: F.concat(F.lit("p"), r["page"].cast("string"), F.lit("-"), r["id"])), ", ")
    texts = _cell(F.array_join(F.array_distinct(F.transform("rows", lambda r: r["translation"])), " / "))
    return found.select("n", F.col("rows")[0]["page"].alias("first_page"), _cell(F.col("rows")[0]["source_text"]).alias("source"), locations.alias("locations"), texts.alias("translations")).orderBy(F.desc("n"), "first_page", "source")


def page_texts(regions: DataFrame) -> DataFrame:
    """``page, text``: every region with its place, type, source and translation."""
    one = F.concat(F.lit("#### ["), place(), F.lit("] "), F.col("type"), F.lit("\n\nEnglish: "), F.col("source_text"), F.lit("\n\nChinese: "), F.col("translation"), F.lit("\n"))
    rows = F.array_sort(F.collect_list(F.struct("pos", one.alias("text"))))
    return regions.groupBy("page").agg(F.array_join(F.transform(rows, lambda r: r["text"]), "\n").alias("text"))


def chapter_report(regions: DataFrame, names: DataFrame, glossary: list[tuple[str, str]], constraints: list[str] = ()) -> str:
    """The report of one chapter (page, pos, id, type, source_text, translation): glossary, names, headings, repeats, then all texts by page.

    A chapter is a bounded stretch of a book; its report is one document, put
    together on the driver.  ``names`` comes from ``reports.name_candidates``.
    """

    def table(head: list[str], rows: list[list], none: str) -> list[str]:
        if not rows:
            return [none]
        return ["| " + " | ".join(head) + " |", "|" + "---|" * len(head), *("| " + " | ".join(map(str, r)) + " |" for r in rows)]

    lines = ["# Review input", "", "## Glossary", "", *table(["English", "Chinese"], [list(g) for g in glossary], "none")]
    if constraints:
        lines += ["", "## Constraints", "", *(f"- {x}" for x in constraints)]
    shown = [[r["name"], r["n"], ", ".join(r["locations"]), " / ".join(r["examples"])] for r in names.collect()]
    lines += ["", "## Names", "", *table(["English", "count", "places", "translations"], shown, "none")]
    found = [[r.place, r.source, r.translation] for r in headings(regions).orderBy("page", "pos").collect()]
    lines += ["", "## Headings", "", *table(["place", "English", "Chinese"], found, "none")]
    again = [[r.source, r.locations, r.translations] for r in repeated_texts(regions).collect()]
    lines += ["", "## Repeated texts", "", *table(["English", "places", "translations"], again, "none")]
    lines += ["", "## Pages", ""]
    for r in page_texts(regions).orderBy("page").collect():
        lines += [f"### Page {r.page}", "", r.text]
    return "\n".join(lines).rstrip() + "\n"


# Placing final texts on pages.


def written_regions(mappings: DataFrame, overrides: DataFrame, writer: dict, sizes: dict[str, float], alignments: dict[str, str]) -> DataFrame:
    """A row for each mapping: why it is not written, or where and how it is.

    ``mappings`` as schemas.MAPPING, ``overrides`` as schemas.LAYOUT_OVERRIDE;
    ``writer`` holds the writer's rules.  Overrides of unknown regions and
    unknown alignments are refused.
    """
    validate.strict(overrides, overrides.join(mappings, ["page", "id"], "left_anti"), "overrides of unknown regions")
    closed = {"alignment": ["left", "center", "right"], "vertical_alignment": ["top", "center"]}
    for name, allowed in closed.items():
        validate.strict(overrides, overrides.where(F.col(name).isNotNull() & ~F.col(name).isin(allowed)), name)
    o = overrides.select("page", "id", F.struct(*[F.col(c) for c in overrides.columns if c not in ("page", "id")]).alias("o"))
    rows = mappings.join(o, ["page", "id"], "left")
    has_box = F.col("placement_box").isNotNull() & (F.size("placement_box") > 0)
    placed = has_box | F.col("o.placement_box").isNotNull()
    status = rules.writer_skip(F.col("match_coverage"), F.col("warnings"), placed, F.col("o.skip"), F.col("o.force_write"), writer["minimum_write_match_coverage"], writer["ambiguous_mapping_minimum_coverage"])
    box = F.coalesce("o.placement_box", "placement_box")
    dx, dy = (F.coalesce(F.col(f"o.{c}"), F.lit(0.0)) for c in ("offset_x", "offset_y"))
    moved = F.array(box[0] + dx, box[1] + dy, box[2] + dx, box[3] + dy)
    by_type = lambda table, default: F.coalesce(*[F.when(F.col("type") == k, F.lit(v)) for k, v in table.items()], F.lit(default))
    centred = F.when(F.col("type").isin("dialogue", "question", "caption", "heading", "other"), "center").otherwise("top")
    return rows.select(
        "page",
        "id",
        F.coalesce(status, F.lit("written")).alias("status"),
        "warnings",
        "final_translation",
        F.when(status.isNull(), G.padded(moved, writer["placement_padding_normalized"])).alias("box"),
        F.when(status.isNull(), F.coalesce("o.font_size", by_type(sizes, sizes["other"]))).alias("font_size"),
        F.when(status.isNull(), F.coalesce("o.alignment", by_type(alignments, "left"))).alias("alignment"),
        F.when(status.isNull(), F.coalesce("o.vertical_alignment", centred)).alias("vertical_alignment"),
        F.when(status.isNull(), F.col("o.text_color")).alias("text_color"),
    )


def writer_report(regions: DataFrame) -> DataFrame:
    """One row: number of regions, of each status, and of severe overlaps of written boxes."""
    overlaps = validate.severe_overlaps(regions.where("status = 'written'"), "page", "id").agg(F.count("*").alias("severe_text_overlap_count"))
    return regions.agg(F.count("*").alias("region_count")).join(reports.histogram_map(regions, "status", "status_counts")).join(overlaps)


# The record of a page: which steps are due, and what follows from their results.


def due(pages: DataFrame, records: DataFrame, redo: list[int] = (), resume: bool = True) -> DataFrame:
    """Pages that are to be processed: all, or those without a record and those that are to be done again."""
    if not resume:
        return pages
    return pages.join(records.where(~F.col("page").isin(list(redo))), "page", "left_anti")


def derived(records: DataFrame) -> DataFrame:
    """Everything that follows from the stored call records of study pages.

    ``records`` (page, risk, primary, verifier, translation,
    translation_verifier); the calls may be null but for the primary one.
    """
    calls = ("primary", "verifier", "translation", "translation_verifier")
    found = {c: F.col(f"found_{c}") for c in calls}
    out = answers.with_objects(records, **{f"found_{c}": F.col(f"{c}.content") for c in calls})
    out = out.withColumn("study", answers.study_output(found["primary"], F.col("translation"), found["translation"]))
    ids = F.transform("study.regions", lambda r: r["id"])
    out = out.withColumn("verifier_comparison", answers.study_comparison(found["primary"], F.col("verifier"), found["verifier"]))
    out = out.withColumn("translation_verifier_comparison", answers.translation_comparison(F.col("translation_verifier"), found["translation_verifier"], ids)).drop(*[f"found_{c}" for c in calls])
    out = out.withColumn("review_reasons", answers.study_reasons(F.col("risk"), F.col("verifier_comparison"), F.col("study.reasons"), F.col("translation_verifier_comparison")))
    return out.withColumn("review_required", F.size("review_reasons") > 0)


def to_translate(records: DataFrame) -> DataFrame:
    """``page, request`` of study pages whose reading has regions; the request is the regions as JSON."""
    read = answers.with_objects(records, found=F.col("primary.content")).select("page", answers.study(F.col("found")).alias("s"))
    return read.where(F.size("s.regions") > 0).select("page", F.to_json("s.regions").alias("request"))


def to_verify(records: DataFrame, policy: str = "always") -> DataFrame:
    """``page, request`` of pages whose translations are complete and without reasons to review."""
    if policy != "always":
        return records.where("false").select("page", F.lit("").alias("request"))
    good = records.where((F.size("study.regions") > 0) & (F.size("study.reasons") == 0))
    return good.select("page", F.to_json("study.regions").alias("request"))


def refused_again(records: DataFrame, verify_only: bool) -> DataFrame:
    """``page, violation`` of pages that can't be translated (or verified) again: no study page, an unreadable reading, blank translations."""
    blank = F.exists("study.regions", lambda r: F.coalesce(r["translation"], F.lit("")) == "")
    unread = answers.study(F.col("found"))["error"].isNotNull()
    wrong = rules.first_of({"not a study page": F.col("mode") != "study", **({"missing translations": blank} if verify_only else {"invalid study JSON": unread})})
    return answers.with_objects(records, found=F.col("primary.content")).select("page", wrong.alias("violation")).where("violation IS NOT NULL")
