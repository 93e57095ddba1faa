"""Scans, sinks and validation on files that are written and read back."""

import json

import pytest
from pyspark.sql import functions as F

from vellumine import schemas
from vellumine.operators import validate
from vellumine.sources import scans, sinks

CALL = {"provider": "p", "model": "m", "mode": "study", "status": 200, "elapsed_seconds": 1.5, "usage": "{}", "content": "text", "error": None}


def record(page, required=False, mode="study"):
    regions = [{"id": "a", "type": "other", "source_text": "x < y", "translation": "T"}, {"id": "b", "type": "heading", "source_text": "h", "translation": "U"}]
    return {"page": page, "mode": mode, "image": f"page-{page}.png", "layout": CALL, "primary": CALL, "verifier": None, "study": {"regions": regions, "error": None}, "review_reasons": ["r1", "r2"] if required else [], "review_required": required}


@pytest.fixture
def book(spark, tmp_path):
    for page in (1, 2, 10):
        sinks.write_document(tmp_path / "pages" / f"page-{page:04d}.json", record(page, page == 2))
    return tmp_path


def test_page_records(spark, book):
    records = scans.page_records(spark, str(book / "pages"))
    assert sorted((r.page, r.file_page, r.mode) for r in records.collect()) == [(1, 1, "study"), (2, 2, "study"), (10, 10, "study")]
    regions = scans.regions(records)
    assert {(r.page, r.pos, r.id) for r in regions.collect()} == {(p, k, i) for p in (1, 2, 10) for k, i in enumerate("ab")}
    assert validate.page_inputs(regions, records).isEmpty()
    sinks.write_document(book / "pages" / "page-0003.json", record(4) | {"study": {"regions": [{"id": "a", "translation": ""}, {"id": "a", "translation": "x"}]}})
    sinks.write_document(book / "pages" / "page-0005.json", record(5) | {"study": {"regions": []}})
    again = scans.page_records(spark, str(book / "pages"))
    found = {(r.page, r.violation) for r in validate.page_inputs(scans.regions(again), again).collect()}
    assert found == {(4, "page record"), (4, "blank"), (4, "repeated id"), (5, "no regions")}
    with pytest.raises(ValueError, match="inputs"):
        validate.strict(again, validate.page_inputs(scans.regions(again), again), "inputs")
    (book / "pages" / "page-0006.json").write_text("{broken")
    with pytest.raises(Exception):
        scans.page_records(spark, str(book / "pages")).collect()


def test_documents_with_comments(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1, // one\n "b": "http://x" /* two */}')
    assert tuple(scans.commented_json(spark, str(tmp_path / "a.json"), "a int, b string").first()) == (1, "http://x")
    (tmp_path / "b.json").write_text('{"a": 2}')
    assert scans.json_documents(spark, str(tmp_path / "b.json"), "a int").first().a == 2


def test_listings(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("Zeta book.pdf", "alpha.PDF", "Alpha!.pdf", "notes.txt", "sub/deep.pdf"):
        (tmp_path / name).write_bytes(name.encode())
    listing = scans.pdf_listing(spark, str(tmp_path))
    assert [(r.name, r.slug) for r in listing.collect()] == [("Alpha!.pdf", "Alpha"), ("alpha.PDF", "alpha"), ("Zeta book.pdf", "Zeta_book")]
    assert scans.repeated_slugs(listing).isEmpty()
    images = spark.createDataFrame([("page-1.png", "i1"), ("page-2.png", "i2")], "name string, path string")
    records = spark.createDataFrame([("page-1.json", "r1")], "name string, path string")
    assert {tuple(r) for r in scans.page_pairs(images, records).collect()} == {("page-1", "i1", "r1"), ("page-2", "i2", None)}
    wanted = spark.createDataFrame([(1,), (2,), (3,)], "page int")
    clean = spark.createDataFrame([("page-1-a.png", "x"), ("page-1-b.png", "w"), ("page-2.png", "y"), ("other.png", "z")], "name string, path string")
    assert {tuple(r) for r in scans.cleaned_pages(clean, wanted).collect()} == {(1, 2, "w"), (2, 1, "y"), (3, 0, None)}
    none = spark.createDataFrame([], "page int")
    names = spark.createDataFrame([("page-0007.json",), ("page-x.json",), ("x.json",)], "name string")
    assert [r.page for r in scans.existing_pages(none, names).collect()] == [7] and [r.page for r in scans.existing_pages(wanted, names).collect()] == [1, 2, 3]
    files = scans.files(spark, str(tmp_path), "*.txt")
    assert scans.newest(files).first().path.endswith("notes.txt")
    row = files.first()
    listed = spark.createDataFrame([("notes.txt", row.sha256), ("gone", row.sha256), ("../up", row.sha256), ("notes.txt", "0" * 64), ("notes.txt", "Z")], "name string, sha256 string")
    assert sorted(r.violation for r in validate.changed_files(files, listed).collect()) == ["bad digest", "changed", "missing", "not a bare name"]


def test_overrides(spark, tmp_path):
    path = tmp_path / "o.json"
    kind = f"schema_version int, overrides array<struct<{', '.join(f.replace(' ', ':', 1) for f in schemas.OVERRIDE.split(', '))}>>"
    sinks.write_document(path, {"schema_version": 1, "overrides": [{"page": 1, "id": "a", "final_translation": "x"}, {"page": 1, "id": "a", "final_translation": " "}]})
    rows = scans.overrides(scans.json_documents(spark, str(path), kind))
    assert rows.count() == 2 and {r.violation for r in scans.override_violations(rows).collect()} == {"repeated", "blank"}
    sinks.write_document(path, {"schema_version": 2, "overrides": []})
    with pytest.raises(Exception, match="version"):
        scans.overrides(scans.json_documents(spark, str(path), kind)).collect()


def test_written_pages_replace_their_own(spark, tmp_path):
    path = str(tmp_path / "out")
    frame = lambda *rows: spark.createDataFrame(rows, "page int, v string")
    sinks.write_pages(frame((1, "a"), (2, "b")), path, ["page"])
    sinks.write_pages(frame((2, "c")), path, ["page"])
    assert sorted((r.page, r.v) for r in spark.read.json(path).collect()) == [(1, "a"), (2, "c")]


def test_summaries_and_pages(spark, book):
    records = scans.page_records(spark, str(book / "pages")).drop("file_page")
    sinks.write_summary(records, book / "out", {"source": "b.pdf"})
    manifest = json.loads((book / "out" / "manifest.json").read_text())
    assert manifest["pages"] == [1, 2, 10] and manifest["records"][1]["review_reasons"] == ["r1", "r2"] and manifest["source"] == "b.pdf"
    lines = (book / "out" / "summary.md").read_text().splitlines()
    assert "- to review: 1/3" in lines and "| 2 | 1.5 | 1.5 | - | r1, r2 | yes |" in lines and lines.index("| 2 | 1.5 | 1.5 | - | r1, r2 | yes |") < lines.index("| 10 | 1.5 | 1.5 | - | none | no |")
    texts = {r.page: r.markdown for r in sinks.page_markdown(records).collect()}
    assert texts[2].startswith("# Page 2\n\n> Review: r1, r2\n\n## 1. other") and "x < y" in texts[1]
    regions = scans.regions(records)
    issues = spark.createDataFrame([(1, "a", "why & what")], "page int, id string, explanation string")
    sinks.write_html(regions, records, issues, book / "study.html", "A < B")
    text = (book / "study.html").read_text()
    assert "<title>A &lt; B</title>" in text and "<li>why &amp; what</li>" in text and "x &lt; y" in text and text.index("page-2") < text.index("page-10") and "to review" in text
    decided = regions.withColumn("adjudication", F.when(F.col("id") == "b", F.struct(F.lit("replace").alias("decision"), F.lit("r<").alias("reason"), F.lit("").alias("child_note"))))
    sinks.write_html(decided, records, issues, book / "study.html", "t", reviewed=True)
    text = (book / "study.html").read_text()
    assert "<li>replace</li><li>r&lt;</li></ul>" in text and "why" not in text and "open after review" in text and "decided" in text


def test_adjusted_records(spark):
    rows = spark.createDataFrame([(1, "a", "t", [0, 0, 2, 2], "dialogue", True), (1, "b", "5", [0, 9, 2, 10], "page_number", False), (1, "c", "u", [0, 3, 2, 5], "dialogue", True)], "page int, id string, text string, box array<int>, category string, remove boolean")
    one = sinks.adjusted_record(rows).first().adjusted
    assert one.schema_version == "1.0" and one.categories == {"dialogue": 2, "page_number": 1} and [r.id for r in one.regions] == ["a", "b", "c"]
    blocks = spark.createDataFrame([(1, "block-0001", [0, 0, 2, 5], "block"), (1, "block-0002", [0, 0, 2, 5], "bubble")], "page int, id string, box array<int>, strategy string")
    two = sinks.adjusted_record(rows, blocks=blocks).first().adjusted
    assert two.schema_version == "2.0" and two.strategies == {"block": 1, "bubble": 1} and len(two.blocks) == 2
