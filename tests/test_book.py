"""Reviews, final texts, placements and page records against small worked cases."""

import json

import pytest
from pyspark.sql import functions as F

from vellumine import schemas
from vellumine.operators import book, merge, reports
from vellumine.plans.rules import WRITER

REGIONS = [(1, 0, "a", "dialogue", "One two", "T1"), (1, 1, "b", "heading", "Head | er", "T2"), (2, 0, "a", "other", "one  TWO ", "T3\n")]
DECISIONS = "page int, id string, decision string, final_translation string, reason string, confidence string, child_note string"


@pytest.fixture(scope="module")
def regions(spark):
    return spark.createDataFrame(REGIONS, "page int, pos int, id string, type string, source_text string, translation string")


def test_chapter_decisions(spark, regions):
    decisions = spark.createDataFrame([(1, "a", "replace", " N1 ", " r ", "high", " note "), (1, "b", "discard", "T2", "", "low", ""), (2, "a", "normalize", "N3", None, None, None)], DECISIONS)
    human = spark.createDataFrame([(2, "a")], "page int, id string")
    out, pages = book.adjudicated(regions, decisions, human)
    found = {(r.page, r.id): r for r in out.collect()}
    assert {k: r.translation for k, r in found.items()} == {(1, "a"): "N1", (1, "b"): "T2", (2, "a"): "N3"}
    assert tuple(found[1, "a"].adjudication) == ("replace", "r", "high", "note") and found[2, "a"].original_translation == "T3\n"
    assert sorted((r.page, r.review_required, r.review_reasons) for r in pages.collect()) == [(1, False, []), (2, True, ["codex_adjudication_needs_human"])]
    row = book.application(out, human).first()
    assert (row.applied_count, row.human_review_count) == (3, 1) and [c.id for c in row.changes] == ["a", "b", "a"]
    for bad in ([(3, "a", "replace", "x", "", "", "")], [(1, "a", "replace", " ", "", "", "")], [(1, "a", "drop", "x", "", "", "")], [(1, "b", "discard", "other", "", "", "")], [(1, "a", "replace", "x", "", "", "")] * 2):
        with pytest.raises(ValueError):
            book.adjudicated(regions, spark.createDataFrame(bad, DECISIONS), human)
    with pytest.raises(ValueError, match="review items"):
        book.adjudicated(regions, decisions, spark.createDataFrame([(9, "a")], "page int, id string"))


def reviews_of(spark, changes=()):
    rows = []
    for page, ids in ((1, ["a", "b"]), (2, ["a"])):
        decisions = [{"page": 1, "id": "a", "decision": "replace", "current_translation": "T1", "final_translation": "N1", "reason": "r", "confidence": "high", "child_note": ""}] if page == 1 else []
        rows.append({"schema_version": 5, "review_scope": "book_chapter_page", "page": page, "thread_id": "t", "task_id": "c1", "plan_sha256": "p", "page_sha256": f"h{page}", "region_ids": ids, "decisions": decisions, "human_review": []})
    for page, change in changes:
        rows[page - 1] |= change
    return spark.createDataFrame([json.dumps(r) for r in rows if r.get("page")], "string").select(F.from_json("value", schemas.REVIEW).alias("r")).select("r.*")


def test_book_reviews(spark, regions):
    tasks = spark.createDataFrame([("c1", 1), ("c1", 2)], "task_id string, page int")
    pages = spark.createDataFrame([(1, "study", "h1", ["a", "b"]), (2, "study", "h2", ["a"])], "page int, mode string, sha256 string, region_ids array<string>")
    merged, row = book.merged_reviews(tasks, pages, regions, reviews_of(spark), "p")
    found = {(r.page, r.id): r for r in merged.collect()}
    assert found[1, "a"].translation == "N1" and found[1, "a"].adjudication.source == "codex_book_review" and found[2, "a"].adjudication is None
    row = row.first()
    assert (row.pages, row.page_count, row.region_count, row.decision_count) == ([1, 2], 2, 3, 1)
    assert row.persistent_threads == {"c1": "t"} and row.page_record_hashes == {1: "h1", 2: "h2"} and row.decisions[0].task_id == "c1"
    broken = {
        "plan changed": (reviews_of(spark, [(1, {"plan_sha256": "q"})]), pages),
        "page changed": (reviews_of(spark, [(2, {"page_sha256": "q"})]), pages),
        "no review": (reviews_of(spark).where("page = 1"), pages),
        "no page record": (reviews_of(spark), pages.where("page = 1")),
        "not a study page": (reviews_of(spark), pages.withColumn("mode", F.lit("exact"))),
        "several threads in a task": (reviews_of(spark, [(2, {"thread_id": "u"})]), pages),
        "open human review": (reviews_of(spark, [(1, {"human_review": [{"page": 1, "id": "a"}]})]), pages),
        "region ids": (reviews_of(spark, [(1, {"region_ids": ["a"]})]), pages),
        "task": (reviews_of(spark, [(1, {"task_id": "c2"})]), pages),
        "schema": (reviews_of(spark, [(1, {"schema_version": 4})]), pages),
    }
    for violation, (reviews, records) in broken.items():
        assert violation in {r.violation for r in book.reviewed_pages(tasks, records, reviews, "p").collect()}, violation
        with pytest.raises(ValueError):
            book.merged_reviews(tasks, records, regions, reviews, "p")
    assert book.reviewed_pages(tasks, pages, broken["plan changed"][0], "p", ignore_hashes=True).isEmpty()


def test_final_texts(spark, regions):
    out, _ = book.adjudicated(regions, spark.createDataFrame([(1, "a", "replace", "N1", "why", "high", "n")], DECISIONS), spark.createDataFrame([], "page int, id string"))
    overrides = spark.createDataFrame([(2, "a", " mine ", None)], schemas.OVERRIDE)
    locked, counts = book.final_snapshot(out, overrides)
    found = {(r.page, r.id): (r.final_translation, r.translation_source, r.decision, r.reason, r.child_note, r.locked) for r in locked.collect()}
    assert found == {(1, "a"): ("N1", "codex_adjudication", "replace", "why", "n", True), (1, "b"): ("T2", "saved_page_translation", "unchanged", "", "", True), (2, "a"): ("mine", "human_override", "unchanged", "", "", True)}
    row = counts.first()
    assert (row.region_count, row.page_count, row.translation_source_counts) == (3, 2, {"codex_adjudication": 1, "human_override": 1, "saved_page_translation": 1})
    only, _ = book.final_snapshot(out, overrides, spark.createDataFrame([(1,)], "page int"))
    assert {r.page for r in only.collect()} == {1}
    with pytest.raises(ValueError, match="unknown"):
        book.final_snapshot(out, spark.createDataFrame([(7, "z", "x", "")], schemas.OVERRIDE))
    with pytest.raises(ValueError, match="blank"):
        book.final_snapshot(out.withColumn("translation", F.lit("  ")), overrides)


def test_report_of_a_chapter(spark, regions):
    assert [(r.n, r.first_page, r.source, r.locations, r.translations) for r in book.repeated_texts(regions).collect()] == [(2, 1, "One two", "p1-a, p2-a", "T1 / T3 ")]
    assert [(r.place, r.source) for r in book.headings(regions).collect()] == [("p1-b", "Head \\| er")]
    names = reports.name_candidates(regions, ["one"], r"\bHead\b", "source_text", ["page", "pos"], "translation")
    text = book.chapter_report(regions, names, [("angle", "角")], ["keep numbers"])
    assert "| angle | 角 |" in text and "- keep numbers" in text and "### Page 2\n\n#### [p2-a] other\n\nEnglish: one  TWO " in text
    assert text.index("## Glossary") < text.index("## Names") < text.index("## Headings") < text.index("## Repeated texts") < text.index("## Pages")
    assert "none" in book.chapter_report(regions.limit(0), names.limit(0), [])


def mapping(page, own, box, coverage=1.0, warnings=(), kind="other", confidence="high", items=()):
    return (page, own, kind, "s", "final", "saved_page_translation", box, [], list(items), coverage, confidence, 1, 1, list(warnings))


def test_plan_and_writing(spark):
    box = [100.0, 100.0, 300.0, 200.0]
    rows = [
        mapping(1, "a", box, kind="dialogue", items=[1, 2]),
        mapping(1, "b", [110.0, 110.0, 290.0, 190.0], kind="definition", items=[2]),
        mapping(1, "c", box, 0.5, confidence="low"),
        mapping(1, "d", box, 0.8, ["ambiguous_layout_candidates"], confidence="medium"),
        mapping(2, "e", None, 0.0, ["layout_not_found"], confidence="missing"),
        mapping(2, "f", box),
        mapping(2, "g", box, 0.1),
    ]
    mappings = spark.createDataFrame(rows, schemas.MAPPING)
    by_page, total = book.placement_plan(mappings)
    assert sorted(map(tuple, by_page.collect())) == [(1, 4, 4, 1), (2, 3, 2, 1)]
    row = total.first()
    assert (row.page_count, row.region_count, row.mapped_count, row.unmapped_count, row.layout_item_ownership_conflict_count) == (2, 7, 6, 1, 1)
    assert row.confidence_counts == {"high": 4, "low": 1, "medium": 1, "missing": 1}
    none = [None] * 8
    overrides = spark.createDataFrame([(2, "f", True, *none), (2, "g", None, True, [0.0, 0.0, 10.0, 10.0], 5.0, -2.0, 20.0, "#FF0000", "right", "top")], schemas.LAYOUT_OVERRIDE)
    found = {r.id: r for r in book.written_regions(mappings, overrides, WRITER, WRITER["font_sizes"], WRITER["alignment_by_type"]).collect()}
    assert {k: r.status for k, r in found.items()} == {"a": "written", "b": "written", "c": "skipped_low_confidence", "d": "skipped_ambiguous_mapping", "e": "unmatched_skipped", "f": "skipped_by_override", "g": "written"}
    assert (found["a"].box, found["a"].font_size, found["a"].alignment, found["a"].vertical_alignment) == ([96.0, 100.0, 304.0, 200.0], 11.0, "center", "center")
    assert (found["b"].alignment, found["b"].vertical_alignment) == ("left", "top")
    assert (found["g"].box, found["g"].font_size, found["g"].alignment, found["g"].text_color) == ([1.0, 0.0, 19.0, 8.0], 20.0, "right", "#FF0000")
    report = book.writer_report(book.written_regions(mappings, overrides, WRITER, WRITER["font_sizes"], WRITER["alignment_by_type"])).first()
    assert report.region_count == 7 and report.status_counts["written"] == 3 and report.severe_text_overlap_count == 1
    with pytest.raises(ValueError, match="unknown"):
        book.written_regions(mappings, overrides.withColumn("page", F.lit(9)), WRITER, WRITER["font_sizes"], WRITER["alignment_by_type"])
    with pytest.raises(ValueError, match="alignment"):
        book.written_regions(mappings, overrides.withColumn("alignment", F.lit("middle")), WRITER, WRITER["font_sizes"], WRITER["alignment_by_type"])


def test_page_records(spark):
    reading = json.dumps({"regions": [{"id": "r", "type": "other", "source_text": "one"}]})
    kind = "struct<content:string,error:string>"
    given = lambda c, e=None: {"content": c, "error": e}
    rows = [
        (1, "study", [], given(reading), None, given(json.dumps({"translations": [{"id": "r", "translation": "x"}]})), given(json.dumps({"issues": [{"id": "r", "category": "name", "explanation": "e"}]}))),
        (2, "study", ["f"], given(reading), given(reading), None, None),
        (3, "exact", [], given("no json"), None, None, None),
    ]
    records = spark.createDataFrame(rows, f"page int, mode string, risk array<string>, primary {kind}, verifier {kind}, translation {kind}, translation_verifier {kind}")
    found = {r.page: r for r in book.derived(records).collect()}
    assert found[1].review_reasons == ["translation_semantic_issue"] and found[1].study.regions[0].translation == "x"
    assert found[2].review_reasons == ["f", "translation_api_error_or_empty", "translation_id_mismatch"] and found[3].review_reasons == ["invalid_study_json"]
    assert set(records.columns) < set(book.derived(records).columns) and "found_primary" not in book.derived(records).columns
    assert [r.page for r in book.to_verify(book.derived(records)).collect()] == [1] and book.to_verify(book.derived(records), "never").isEmpty()
    assert {r.page for r in book.to_translate(records).collect()} == {1, 2}
    assert {(r.page, r.violation) for r in book.refused_again(book.derived(records), False).collect()} == {(3, "not a study page")}
    assert {(r.page, r.violation) for r in book.refused_again(book.derived(records), True).collect()} == {(2, "missing translations"), (3, "not a study page")}
    pages = spark.createDataFrame([(k,) for k in (1, 2, 4)], "page int")
    due = lambda **o: sorted(r.page for r in book.due(pages, records.select("page"), **o).collect())
    assert due() == [4] and due(redo=[2]) == [2, 4] and due(resume=False) == [1, 2, 4]


def test_older_decisions_may_change_nothing(spark, regions):
    same = spark.createDataFrame([(1, "a", "replace", "T1", "", "", "")], DECISIONS)
    assert merge.decision_violations(regions, same, older=True).isEmpty()
    assert [r.violation for r in merge.decision_violations(regions, same).collect()] == ["unchanged"]
