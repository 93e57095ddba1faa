"""Sinks: page documents, manifests, Markdown and HTML."""

from __future__ import annotations

import html
import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumine.functions import text as T


def write_pages(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace the pages that ``df`` holds; other pages stay.  The committer publishes whole files."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).json(path)


def write_text(path: str | Path, text: str) -> None:
    """One document on the driver: written beside its place, then renamed."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    with tempfile.NamedTemporaryFile("w", dir=path.parent, suffix=".part", delete=False, encoding="utf-8") as file:
        file.write(text)
    os.replace(file.name, path)


def write_document(path: str | Path, value: object) -> None:
    """One JSON document, written like a text."""
    write_text(path, json.dumps(value, ensure_ascii=False, indent=2) + "\n")


def manifest(records: DataFrame) -> DataFrame:
    """One row: number of pages, of those to review, and all records as JSON, by page."""
    row = F.to_json(F.struct(*records.columns))
    return records.agg(F.count("*").alias("pages"), F.count_if("review_required").alias("to_review"), F.transform(F.array_sort(F.collect_list(F.struct("page", row.alias("record")))), lambda x: x["record"]).alias("records"))


def region_markdown(regions: Column) -> Column:
    """Numbered regions: type, source, translation."""
    one = lambda r, k: F.concat(F.lit("## "), (k + 1).cast("string"), F.lit(". "), r["type"], F.lit("\n\n"), r["source_text"], F.lit("\n\n"), r["translation"], F.lit("\n"))
    return F.array_join(F.transform(regions, one), "\n")


def page_markdown(records: DataFrame) -> DataFrame:
    """``page, markdown``: a study page by its regions, another page by its primary text; review reasons on top."""
    reasons = F.when(F.size("review_reasons") > 0, F.concat(F.lit("> Review: "), F.array_join("review_reasons", ", "), F.lit("\n\n"))).otherwise("")
    body = F.when(F.col("mode") == "study", region_markdown(F.col("study.regions"))).otherwise(F.coalesce("primary.content", F.lit("")))
    return records.select("page", F.concat(F.lit("# Page "), F.col("page").cast("string"), F.lit("\n\n"), reasons, body).alias("markdown"))


def summary_rows(records: DataFrame) -> DataFrame:
    """``page, row``: a Markdown table's row for each page: seconds of the three readings, reasons, and whether to review."""
    seconds = lambda c: F.coalesce(F.col(f"{c}.elapsed_seconds").cast("string"), F.lit("-"))
    reasons = F.when(F.size("review_reasons") > 0, F.array_join("review_reasons", ", ")).otherwise("none")
    cells = [F.col("page").cast("string"), *map(seconds, ("layout", "primary", "verifier")), reasons, F.when(F.col("review_required"), "yes").otherwise("no")]
    return records.select("page", F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("row"))


def write_summary(records: DataFrame, folder: str | Path, about: dict) -> None:
    """``manifest.json`` and ``summary.md`` of a book: what was run, all records by page, and the table of pages."""
    row = manifest(records).first()
    write_document(Path(folder) / "manifest.json", about | {"pages": [json.loads(r)["page"] for r in row.records], "records": list(map(json.loads, row.records))})
    head = [f"- {k}: {v}" for k, v in about.items()] + [f"- to review: {row.to_review}/{row.pages}", ""]
    table = ["| page | layout s | primary s | verifier s | reasons | review |", "|---:|---:|---:|---:|---|:---:|"]
    lines = [r.row for r in summary_rows(records).orderBy("page").collect()]  # a book's pages
    write_text(Path(folder) / "summary.md", "\n".join(["# Summary", "", *head, *table, *lines, ""]))


def region_cards(regions: DataFrame, issues: DataFrame, reviewed: bool = False) -> DataFrame:
    """``page, html``: a card for each region; all text escaped.

    A card shows the issues found in the region, or, once pages are reviewed,
    the decision on it (column ``adjudication``) with its reason and its note.
    """
    notes = issues.groupBy("page", "id").agg(F.array_sort(F.collect_list("explanation")).alias("notes"))
    cell = lambda c: T.html_escaped(F.coalesce(c, F.lit("")))
    listed = lambda items: F.array_join(F.transform(items, lambda n: F.concat(F.lit("<li>"), T.html_escaped(n), F.lit("</li>"))), "")
    if reviewed:
        decision = F.col("adjudication")
        parts = F.array(decision["decision"], decision["reason"], decision["child_note"])
        shown = regions.withColumn("shown", F.when(decision.isNotNull(), F.filter(parts, lambda x: F.coalesce(x, F.lit("")) != "")).otherwise(F.array().cast("array<string>")))
    else:
        shown = regions.join(notes, ["page", "id"], "left").withColumn("shown", F.coalesce("notes", F.array().cast("array<string>")))
    card = F.concat(F.lit('<section id="'), cell(F.col("id")), F.lit('"><p>'), cell(F.col("source_text")), F.lit("</p><p>"), cell(F.col("translation")), F.lit("</p><ul>"), listed(F.col("shown")), F.lit("</ul></section>"))
    cards = shown.select("page", "pos", card.alias("card"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "card")))
    return cards.groupBy("page").agg(F.array_join(F.transform(ordered, lambda x: x["card"]), "\n").alias("html"))


def page_states(pages: DataFrame, reviewed: bool = False) -> DataFrame:
    """``page, state, reasons``: what a page's heading says."""
    states = ("open after review", "decided") if reviewed else ("to review", "passed")
    reasons = F.when(F.size("review_reasons") > 0, T.html_escaped(F.array_join("review_reasons", ", "))).otherwise("none")
    return pages.select("page", F.when(F.col("review_required"), states[0]).otherwise(states[1]).alias("state"), reasons.alias("reasons"))


def write_html(regions: DataFrame, pages: DataFrame, issues: DataFrame, path: str | Path, title: str, reviewed: bool = False) -> None:
    """One HTML document of a book: a section for each page, with its state, its picture (column ``image``) and its cards."""
    cards, states = region_cards(regions, issues, reviewed), page_states(pages, reviewed)
    picture = T.html_escaped(F.coalesce(F.col("image"), F.lit("")))
    rows = pages.select("page", picture.alias("image")).join(states, "page").join(cards, "page", "left").orderBy("page")
    sections = [f'<article id="page-{r.page}"><h2>{r.page}</h2><p class="state">{r.state}</p><p>{r.reasons}</p><img src="{r.image}" alt="{r.page}">{r.html or "<p>no regions</p>"}</article>' for r in rows.toLocalIterator()]
    head = html.escape(title)
    write_text(path, f'<!doctype html>\n<html><head><meta charset="utf-8"><title>{head}</title></head>\n<body><h1>{head}</h1>\n' + "\n".join(sections) + "\n</body></html>\n")


def adjusted_record(df: DataFrame, space: int = 1000, blocks: DataFrame | None = None) -> DataFrame:
    """``page, adjusted``: a page's regions in pixels and its erasure summary; with ``blocks`` (page, id, box, strategy) also these, and how many of each strategy."""
    kinds = df.groupBy("page", "category").agg(F.count("*").alias("n")).groupBy("page").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "n")))).alias("categories"))
    rows = df.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("id", "text", "box", "category", "remove"))).alias("regions"))
    head = [F.lit("2.0" if blocks is not None else "1.0").alias("schema_version"), F.lit(space).alias("coordinate_max")]
    both, fields = rows.join(kinds, "page"), ["regions", "categories"]
    if blocks is not None:
        used = blocks.groupBy("page", "strategy").agg(F.count("*").alias("n")).groupBy("page").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("strategy", "n")))).alias("strategies"))
        listed = blocks.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("id", "box", "strategy"))).alias("blocks"))
        both, fields = both.join(listed.join(used, "page"), "page", "left"), [*fields, "blocks", "strategies"]
    return both.select("page", F.struct(*head, *fields).alias("adjusted"))
