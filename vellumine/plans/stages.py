"""Stages of a book's pipeline on files, and their command line.

``python -m vellumine.plans.stages STAGE`` runs one stage for every book that
the configuration names; the first stage that fails ends the run.  What reads
pictures or calls models is a plug-in: ``reader`` and ``reviewer`` are functions
that a caller passes, and stubs answer without a network.  Each stage leaves
its results as documents of the book, which the next one reads.
"""

from __future__ import annotations

import argparse
import contextlib
import io
import json
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumine import schemas
from vellumine.functions import text as T
from vellumine.operators import book as B
from vellumine.operators import placement, ranges, reports, validate
from vellumine.plans import config as C
from vellumine.plans import providers, review
from vellumine.plans.config import Artefacts, ConfigError
from vellumine.plans.settings import ReviewSettings, RunSettings, WriterSettings, discovered, enter
from vellumine.sources import sinks
from vellumine.sources.staging import staged

STAGES = ("read", "review", "finalize", "erase", "write")
REGIONS = "page int, mode string, layout struct<content:string>, study struct<regions:array<struct<id:string,type:string,source_text:string,translation:string>>>"


class Teed(io.TextIOBase):
    """A stream that writes to several."""

    def __init__(self, *streams):
        self.streams = streams

    def write(self, text: str) -> int:
        for s in self.streams:
            s.write(text)
        return len(text)

    def flush(self) -> None:
        for s in self.streams:
            s.flush()

    def isatty(self) -> bool:
        return any(s.isatty() for s in self.streams)


@contextlib.contextmanager
def logged(path: Path | None) -> Iterator[None]:
    """What is printed also goes to a file."""
    if path is None:
        yield
        return
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("a", encoding="utf-8") as file, contextlib.redirect_stdout(Teed(sys.stdout, file)), contextlib.redirect_stderr(Teed(sys.stderr, file)):
        yield


@dataclass
class Run:
    """What a stage works with."""

    spark: SparkSession
    root: Path
    settings: RunSettings
    args: argparse.Namespace
    reader: Callable[[], providers.Provider] = field(default=lambda: providers.stub)
    reviewer: review.Reviewer = review.stub

    def pages(self, book: Artefacts) -> DataFrame:
        """Page records of a book."""
        some(book.folder("read") / "pages", "page-*.json")
        return self.spark.read.schema(REGIONS).json(f"{book.folder('read')}/pages/page-*.json", multiLine=True)


def some(folder: Path, pattern: str) -> None:
    """Raises where a stage's input is not there."""
    if not any(folder.glob(pattern)):
        raise ConfigError(f"no {pattern} in {folder}")


def regions_of(pages: DataFrame) -> DataFrame:
    rows = pages.select("page", F.posexplode("study.regions").alias("pos", "r"))
    return rows.select("page", "pos", "r.id", "r.type", "r.source_text", "r.translation")


def read(run: Run, book: Artefacts) -> int:
    """Readings of all wanted pages that have no record: what the reader says of each rendered page."""
    folder = book.folder("read") / "pages"
    wanted = run.spark.createDataFrame([(int(p.stem.removeprefix("page-")), str(p)) for p in sorted(folder.glob("page-*.png"))], "page int, path string")
    if run.settings.pages:
        wanted = wanted.join(run.spark.range(1).select(F.explode(T.page_spec(F.lit(run.settings.pages))).alias("page")), "page", "left_semi")
    done = run.spark.createDataFrame([(int(p.stem.removeprefix("page-")),) for p in sorted(folder.glob("page-*.json"))], "page int")
    redo = [r.page for r in run.spark.range(1).select(F.explode(T.page_spec(F.lit(run.settings.redo_pages))).alias("page")).collect()] if run.settings.redo_pages else []
    due = B.due(wanted, done, redo, run.settings.resume)
    print(f"pages to read: {due.count()}")
    if run.args.dry_run:
        return 0
    calls = providers.called(due, "path", run.reader, "reader", "model", "study", "primary")
    none = F.lit(None).cast(schemas.CALL)
    records = B.derived(calls.select("page", F.lit("study").alias("mode"), "primary", none.alias("verifier"), none.alias("translation"), none.alias("translation_verifier"), F.array().cast("array<string>").alias("risk")))
    for row in records.toLocalIterator():  # a document for each page
        sinks.write_document(folder / f"page-{row.page:04d}.json", json.loads(json.dumps(row.asDict(recursive=True))))
    return 0


def tasks_of(book: Artefacts) -> dict:
    path = book.document("review", "book-review-plan")
    if not path.is_file():
        raise ConfigError(f"no plan: {path}")
    return json.loads(path.read_text(encoding="utf-8"))


def plan(run: Run, book: Artefacts) -> int:
    """The plan of a book from its table of contents: one task for each range of pages."""
    toc = book.document("review", "toc")
    if not toc.is_file():
        raise ConfigError("the table of contents has not been read")
    found = json.loads(toc.read_text(encoding="utf-8"))
    settings = ReviewSettings.of(run.settings.config)
    entries = run.spark.createDataFrame([(k, e["kind"], e["title"], int(e["printed_start_page"])) for k, e in enumerate(found["entries"])], "pos int, kind string, title string, printed_start_page int")
    tasks = ranges.book_plan(entries, found["pdf_page_count"], found["printed_to_pdf_offset"], found["toc_pdf_pages"], settings.exclude_preliminary, settings.exclude_back_matter)
    rows = [r.asDict(recursive=True) for r in tasks.orderBy("pdf_start_page").collect()]  # chapters of a book
    if not run.args.dry_run:
        sinks.write_document(book.document("review", "book-review-plan"), {"schema_version": 1, "tasks": rows, "source": found})
    print(f"tasks: {len(rows)}")
    return 0


def review_pages(run: Run, book: Artefacts) -> int:
    """Reviews of all planned pages that have none, in the plan's order; each is saved before the next begins."""
    settings = ReviewSettings.of(run.settings.config)
    if not book.document("review", "book-review-plan").is_file() and (result := plan(run, book)):
        return result
    if run.args.dry_run:
        return 0
    for task in tasks_of(book)["tasks"]:
        for page in range(int(task["pdf_start_page"]), int(task["pdf_end_page"]) + 1):
            source = book.folder("read") / "pages" / f"page-{page:04d}.json"
            target = book.folder("review") / str(task["task_id"]) / f"page-{page:04d}-codex-review.json"
            if target.is_file() and not run.args.force:
                continue
            inputs = review.load_page(source, settings.image_mode != "never")
            found, stages, used = review.reviewed(inputs, run.reviewer, settings.image_mode, settings.ignore_hash_validation)
            document = review.result_document(used, found, stages, {"model": settings.model, "reasoning_effort": settings.reasoning_effort, "image_mode": settings.image_mode}, book=True, thread_id=str(task["task_id"]))
            own = {"task_id": task["task_id"], "thread_id": str(task["task_id"]), "plan_sha256": review.digest(book.document("review", "book-review-plan")), "page_sha256": review.digest(source), "region_ids": inputs.ids}
            sinks.write_document(target, document | own)
    return 0


def finalize(run: Run, book: Artefacts) -> int:
    """Reviews merged into the regions, final texts locked, and their places on the pages."""
    spark, plan_path = run.spark, book.document("review", "book-review-plan")
    rows = [(str(t["task_id"]), p) for t in tasks_of(book)["tasks"] for p in range(int(t["pdf_start_page"]), int(t["pdf_end_page"]) + 1)]
    tasks = spark.createDataFrame(rows, "task_id string, page int")
    pages = run.pages(book)
    content = spark.read.format("binaryFile").load(f"{book.folder('read')}/pages/page-*.json").select(F.regexp_extract("path", r"page-(\d+)\.json$", 1).cast("int").alias("page"), F.sha2("content", 256).alias("sha256"))
    records = pages.select("page", "mode", F.transform("study.regions", lambda r: r["id"]).alias("region_ids")).join(content, "page")
    some(book.folder("review"), "*/page-*-codex-review.json")
    reviews = spark.read.schema(schemas.REVIEW).json(f"{book.folder('review')}/*/page-*-codex-review.json", multiLine=True)
    regions, aggregate = B.merged_reviews(tasks, records, regions_of(pages), reviews, review.digest(plan_path), run.settings.ignore_hash_validation)
    people = book.folder("overrides") / "translations.json"
    overrides = spark.createDataFrame([], schemas.OVERRIDE)
    if people.is_file():
        given = json.loads(people.read_text(encoding="utf-8"))
        if given.get("schema_version") != 1:
            raise ConfigError("unsupported override version")
        overrides = spark.createDataFrame([(int(o["page"]), str(o["id"]), str(o.get("final_translation", "")), str(o.get("reason", ""))) for o in given.get("overrides", [])], schemas.OVERRIDE)
        validate.strict(overrides, overrides.groupBy("page", "id").count().where("count > 1"), "repeated overrides")
        validate.strict(overrides, overrides.where("trim(final_translation) = ''"), "blank overrides")
    locked, counts = B.final_snapshot(regions, overrides)
    locked = staged(locked, "locked")
    mappings = staged(placement.map_regions(locked.join(regions.select("page", "id", "pos"), ["page", "id"]), pages.select("page", "layout.content")), "mappings")
    by_page, summary = B.placement_plan(mappings)
    print(json.dumps(counts.first().asDict(), ensure_ascii=False))
    if run.args.dry_run:
        return 0
    listed = lambda df, *order: [json.loads(r.value) for r in df.select(F.to_json(F.struct("*")).alias("value"), *order).orderBy(*order).collect()]  # noqa: E731  a book's documents
    one = lambda df: json.loads(df.select(F.to_json(F.struct("*")).alias("value")).first().value)
    sinks.write_document(book.document("final", "book-adjudication"), one(aggregate))
    sinks.write_document(book.document("final", "translation-final"), {"schema_version": 1, "status": "locked_final_translation", **one(counts), "regions": listed(locked, "page", "id")})
    sinks.write_document(book.document("final", "placement-plan"), {"schema_version": 1, **one(summary), "pages": listed(by_page, "page"), "mappings": listed(mappings, "page", "id")})
    return 0


def erase(run: Run, book: Artefacts) -> int:
    """Pages with their text painted over, as PNG files."""
    from vellumine.functions import imaging
    from vellumine.sources import png

    folder = book.folder("read") / "pages"
    some(folder, "page-*.png")
    files = run.spark.read.format("binaryFile").load(f"{folder}/page-*.png")
    pictures = png.images(files).select(F.regexp_extract("path", r"page-(\d+)\.png$", 1).cast("int").alias("page"), "width", "height", "pixels", "alpha", "error")
    validate.strict(pictures, pictures.select("page", "error").where("error IS NOT NULL"), "pictures")
    items = run.pages(book).select("page", F.explode(T.grounded_regions(F.col("layout.content"))).alias("item"))
    boxes = items.select("page", F.explode(T.lenient_boxes(F.col("item.box"))).alias("box")).join(pictures.select("page", "width", "height"), "page")
    from vellumine.functions import geometry as G

    pixels = boxes.select("page", G.to_pixels(F.col("box"), F.col("width"), F.col("height")).alias("box")).groupBy("page").agg(F.collect_list("box").alias("boxes"))
    clean = imaging.erased(pictures.join(pixels, "page"), run.args.strategy).join(pictures.select("page", "width", "height", "alpha"), "page")
    for row in png.files(clean).toLocalIterator():  # a file for each page
        path = book.page("erased", row.page, "png")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(bytes(row.content))
    return 0


def write(run: Run, book: Artefacts) -> int:
    """How each text is written, and the report; the PDF itself is a plug-in's."""
    rules = WriterSettings.of(run.settings.config, run.root).rules
    planned = json.loads(book.document("final", "placement-plan").read_text(encoding="utf-8"))
    mappings = run.spark.createDataFrame([json.dumps(m) for m in planned["mappings"]], "string").select(F.from_json("value", schemas.MAPPING).alias("m")).select("m.*")
    overrides = run.spark.createDataFrame([], schemas.LAYOUT_OVERRIDE)
    given = book.folder("overrides") / "layout.json"
    if given.is_file():
        overrides = layout_overrides(run.spark, json.loads(given.read_text(encoding="utf-8")))
    rows = B.written_regions(mappings, overrides, rules, rules["font_sizes"], rules["alignment_by_type"])
    report = B.writer_report(rows).first().asDict()
    print(json.dumps(report, ensure_ascii=False))
    if not run.args.dry_run:
        regions = [json.loads(r.value) for r in rows.select(F.to_json(F.struct("*")).alias("value"), "page", "id").orderBy("page", "id").collect()]
        sinks.write_document(book.document("written", "writer-report"), {"schema_version": 1, **report, "regions": regions})
    return 0


def layout_overrides(spark: SparkSession, document: dict) -> DataFrame:
    """Layout overrides of a document: version 1, closed fields, one for each region."""
    if not isinstance(document, dict) or document.get("schema_version") != 1 or not isinstance(document.get("regions"), list):
        raise ConfigError("unsupported layout overrides")
    names = [f.split()[0] for f in schemas.LAYOUT_OVERRIDE.split(", ")]
    for raw in document["regions"]:
        C.closed(raw, set(names), f"layout override of {raw.get('page') if isinstance(raw, dict) else raw}")
    rows = spark.createDataFrame([json.dumps(r) for r in document["regions"]], "string").select(F.from_json("value", schemas.LAYOUT_OVERRIDE).alias("o")).select("o.*")
    return validate.strict(rows, reports.duplicates(rows, ["page", "id"]), "repeated layout overrides")


RUNNERS = {"read": read, "plan": plan, "review": review_pages, "finalize": finalize, "erase": erase, "write": write}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="vellumine", description="Run one stage for every book")
    out.add_argument("--config", type=Path, help="configuration (JSON with comments)")
    out.add_argument("--output", type=Path, default=Path("runs"), help="folder of all books")
    stages = out.add_subparsers(dest="stage", required=True)
    for name in RUNNERS:
        one = stages.add_parser(name)
        one.add_argument("--dry-run", action="store_true", help="say what is due, write nothing")
        one.add_argument("--force", action="store_true", help="do again what is done")
        one.add_argument("--log-file", type=Path)
        if name == "erase":
            one.add_argument("--strategy", choices=("auto", "block", "bubble"), default="auto")
    return out


def books(pdf: Path, output: Path) -> list[Artefacts]:
    """The books of a PDF file, or of all in a folder (not below it), by name; no two may have one folder."""
    if pdf.is_file():
        if pdf.suffix.lower() != ".pdf":
            raise ConfigError(f"not a PDF file: {pdf}")
        found = [pdf]
    else:
        found = sorted((p for p in pdf.iterdir() if p.is_file() and p.suffix.lower() == ".pdf"), key=lambda p: p.name.casefold()) if pdf.is_dir() else []
    if not found:
        raise ConfigError(f"no PDF files: {pdf}")
    out = [Artefacts.of(p, output) for p in found]
    names = [a.book for a in out]
    if again := sorted({n for n in names if names.count(n) > 1}):
        raise ConfigError(f"several files of one name: {', '.join(again)}")
    return out


def main(arguments: list[str] | None = None, root: Path | None = None, spark: SparkSession | None = None, **plugins) -> int:
    """Exit status: 0, 2 for a wrong configuration or broken rule, or that of the first stage that failed."""
    root = root or Path.cwd()
    enter(root)
    arguments = sys.argv[1:] if arguments is None else arguments
    args = parser().parse_args(arguments)
    try:
        path = discovered(arguments, root)
        if path is None:
            raise ConfigError("no configuration")
        settings = RunSettings.load(path, root)
        if settings.pdf is None:
            raise ConfigError("the configuration names no PDF")
        found = books(settings.pdf, (root / args.output).resolve())  # paths for Spark, whose working directory is another
        run = Run(spark or SparkSession.builder.getOrCreate(), root, settings, args, **plugins)
        with logged(args.log_file):
            for k, one in enumerate(found, 1):
                print(f"[{k}/{len(found)}] stage={args.stage} book={one.book}", flush=True)
                if result := RUNNERS[args.stage](run, one):
                    return result
        return 0
    except (ConfigError, review.ReviewError, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
