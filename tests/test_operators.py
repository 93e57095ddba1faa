from pyspark.sql import functions as F

from vellumine import schemas
from vellumine.functions import imaging, stats
from vellumine.operators import layout, merge, placement, ranges, reports, rules, validate
from vellumine.streaming import incremental

import numpy as np
import pytest


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_book_plan(spark):
    """104 pages, offset 1: front matter, three chapters, sections, an index that is left out."""
    entries = [("front_matter", "Contents", 5), ("front_matter", "Guide", 6), ("chapter", "A", 12), ("section", "A1", 14), ("chapter", "B", 42), ("section", "B1", 50), ("chapter", "C", 66), ("index", "Index", 100)]
    toc = spark.createDataFrame([("b", 104, 1, [(k, t, p, 3, None, "high") for k, t, p in entries])], f"book string, pdf_page_count int, printed_to_pdf_offset int, entries array<{schemas.TOC_ENTRY}>")
    plan = ranges.book_plan(toc, exclude_preliminary=False)
    tasks = rows(plan.where("NOT excluded"), "pdf_start_page", "pdf_end_page", "task_id")
    assert tasks == [(1, 5, "preliminary"), (6, 12, "front-matter"), (13, 42, "chapter-01"), (43, 66, "chapter-02"), (67, 100, "chapter-03")]
    assert rows(plan.where("excluded"), "pdf_start_page", "pdf_end_page") == [(101, 104)]
    assert rows(plan.where("kind = 'chapter'"), "title", "sections") == [("A", ["A1"]), ("B", ["B1"]), ("C", [])]
    assert ranges.plan_violations(plan.where("NOT excluded"), toc).count() == 0


def test_usage(spark):
    raw = spark.createDataFrame([(1000, 700, 0, 500, 100, 1500), (1, 2, 0, 0, 0, -1)], "inputTokens long, cachedInputTokens long, cacheWriteInputTokens long, outputTokens long, reasoningOutputTokens long, totalTokens long")
    found = raw.select(reports.usage(F.struct("*")).alias("u")).collect()
    assert found[0].u.non_cached_input_tokens == 300 and found[1].u is None


def test_snapshot_priority_and_validation(spark):
    regions = spark.createDataFrame([(1, "a", "other", "s", "old"), (1, "b", "other", "s", "old"), (1, "c", "other", "s", "old")], "page int, id string, type string, source_text string, translation string")
    decisions = spark.createDataFrame([(1, "a", "replace", "new", "r", ""), (1, "b", "replace", "new", "r", "")], "page int, id string, decision string, final_translation string, reason string, child_note string")
    people = spark.createDataFrame([(1, "b", "mine", "because")], schemas.OVERRIDE)
    snap = merge.locked_snapshot(regions, decisions, people)
    assert rows(snap, "id", "final_translation", "translation_source") == [("a", "new", "codex_adjudication"), ("b", "mine", "human_override"), ("c", "old", "saved_page_translation")]
    assert validate.snapshot(snap, 3).count() == 0 and validate.snapshot(snap, 4).count() == 1
    bad = spark.createDataFrame([(1, "a", "replace", "old", "", ""), (1, "x", "replace", "y", "", ""), (1, "c", "discard", "z", "", "")], decisions.schema)
    assert rows(merge.decision_violations(regions, bad), "id", "violation") == [("a", "unchanged"), ("c", "discard changes text"), ("x", "unknown")]
    with pytest.raises(ValueError):
        validate.strict(regions, merge.decision_violations(regions, bad), "decisions")


def test_region_mapping(spark):
    """Equal texts are paired by position; a split text is joined; a text that no item holds is missing."""
    content = "".join(f"<|ref|>{t}<|/ref|><|det|>[[{b}]]<|/det|>" for t, b in [("Hello there", "100,100,300,180"), ("Hello there", "600,700,800,780"), ("The quick brown", "100,400,300,420"), ("fox jumps", "100,425,300,445")])
    regions = [(1, k, i, "dialogue", t, "x", "saved_page_translation") for k, (i, t) in enumerate([("r1", "Hello there!"), ("r2", "Hello, there"), ("r3", "The quick brown fox jumps"), ("r4", "nothing like it")])]
    frame = spark.createDataFrame(regions, "page int, pos int, id string, type string, source_text string, final_translation string, translation_source string")
    found = {r.id: r for r in placement.map_regions(frame, spark.createDataFrame([(1, content)], "page int, content string")).collect()}
    assert found["r1"].placement_box == [100.0, 100.0, 300.0, 180.0] and found["r2"].placement_box == [600.0, 700.0, 800.0, 780.0]
    assert found["r3"].layout_item_indexes == [2, 3] and found["r3"].match_coverage == 1.0 and found["r3"].confidence == "high"
    assert found["r4"].confidence == "missing" and found["r4"].warnings == ["layout_not_found"]
    assert reports.shared_items(placement.map_regions(frame, spark.createDataFrame([(1, None)], "page int, content string"))).count() == 0


def test_components_match_search(spark):
    rng = np.random.default_rng(3)
    boxes = rng.integers(0, 400, (40, 2))
    boxes = np.concatenate((boxes, boxes + rng.integers(5, 60, (40, 2))), axis=1).astype(float)
    near = layout.touching(boxes)
    label = layout.component_labels(near)
    for start in range(40):
        seen, todo = set(), [start]
        while todo:
            k = todo.pop()
            if k not in seen:
                seen.add(k)
                todo += np.flatnonzero(near[k] | near[:, k]).tolist()
        assert label[start] == min(seen)


def test_risk_rules(spark):
    schema = "page int, layout_content string, layout_error string, primary_content string, primary_error string"
    data = [(1, "<|ref|>alpha beta gamma delta<|/ref|><|det|>[[1,1,2,2]]<|/det|>", None, "alpha [Uncertain]", None), (2, "alpha", None, " ", "timeout")]
    found = {r.page: r.risk_flags for r in rules.exact_risk(spark.createDataFrame(data, schema)).collect()}
    assert found == {1: ["primary_uncertain", "possible_region_omission"], 2: ["primary_api_error_or_empty", "possible_region_omission"]}


def test_verifier(spark):
    frame = spark.createDataFrame([("A 12 b", "a 12  B", None), ("A 12 b", "a 13 b", None), ("x", "x", "late")], "primary_content string, verifier_content string, verifier_error string")
    assert [r.needs_review for r in rules.verifier_comparison(frame).collect()] == [False, True, True]


def test_two_pass_and_upsert(spark):
    frame = lambda *x: spark.createDataFrame(list(x), "id string, v int")
    order = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "id string, pos int")
    merged = merge.two_pass(frame(("a", 1), ("b", 1)), frame(("b", 2)), frame(("b", 0)), order)
    assert [tuple(r) for r in merged.collect()] == [("a", 1), ("b", 2)]
    assert rows(merge.upsert(frame(("a", 1), ("b", 1)), frame(("b", 9), ("c", 9)), ["id"]), "id", "v") == [("a", 1), ("b", 9), ("c", 9)]


def test_resume(spark, tmp_path):
    work = spark.createDataFrame([(1, "a"), (2, "b")], "page int, x string")
    step = lambda df: df.withColumn("x", F.upper("x"))
    path = str(tmp_path / "done")
    assert rows(incremental.resume(spark, work.limit(1), ["page"], step, path, "page int, x string"), "x") == [("A",)]
    assert rows(incremental.resume(spark, work, ["page"], step, path, "page int, x string"), "x") == [("A",), ("B",)]
    again = incremental.resume(spark, work, ["page"], lambda df: df.withColumn("x", F.lit("z")), path, "page int, x string", redo=True)
    assert rows(again, "x") == [("z",), ("z",)]


def test_streaming(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    spark.range(5).write.parquet(source)
    incremental.run_available(spark, source, "id long", lambda df: df.withColumn("y", F.col("id") * 2), out, check)
    spark.range(5, 7).write.mode("append").parquet(source)
    incremental.run_available(spark, source, "id long", lambda df: df.withColumn("y", F.col("id") * 2), out, check)
    assert rows(spark.read.parquet(out), "y") == [(2 * k,) for k in range(7)]


def test_statistics_and_erasure(spark):
    frame = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3, 4, 100)], "g string, v double")
    assert stats.robust_thresholds(frame, ["g"], "v", 5.0).first().threshold == pytest.approx(3 + 4 * 1.4826)
    # 0.1 and 0.5 are equally far from 0.3, but not in doubles.
    frame = spark.createDataFrame([("a", x) for x in (0.1, *[0.3] * 7, 0.5, 9.0, 9.0)], "g string, v double")
    assert stats.coherent_medians(frame, ["g"], "v", 0.7, 0.0).first().kept == 9
    image = np.full((40, 60, 3), 200, np.uint8)
    image[10:20, 10:40] = 0
    clean, painted, blocks, owner = imaging.erase_blocks(image, [[10, 10, 40, 20]], strategy="block")
    assert (clean == 200).all() and len(blocks) == 1 and owner == [0] and painted.sum() == 34 * 14
    assert blocks[0]["sampling"] == "union_of_per_line_outer_rings"


def test_ink_is_found_by_colour_and_by_darkness_and_repaired():
    image = np.full((80, 140, 3), 200, np.uint8)
    image[30:40, 40:60] = 170  # darker by more than 26
    image[30:40, 70:80] = 180  # darker by less
    image[30:40, 90:95] = (0, 0, 255)  # as light as the page is not
    image[25:26, 20:130] = 0  # a rule over the whole width
    mask, area, figures = imaging.region_ink(image, (35, 28, 100, 42))
    whole = imaging.merged(np.zeros((80, 140), bool), mask, area)
    assert whole[30:40, 40:60].all() and whole[30:40, 90:95].all() and whole.sum() == 200 + 50
    assert figures["selected"] == 250 and figures["colored_ink_fraction"] == 0.2
    clean, mask, _ = imaging.erase_ink(image, [(35, 28, 100, 42)])
    assert (clean[30:40, 40:60] == 200).all() and (clean[30:40, 90:95] == 200).all() and (clean[30:40, 70:80] == 180).all()
    only, alpha = imaging.overlay(image, mask)
    assert (only[alpha == 0] == 0).all() and (only[35, 50] == 200).all()
    with pytest.raises(ValueError):
        imaging.merged(np.zeros((80, 140), bool), mask, (0, 0, 5, 5))


def test_background_of_a_block_falls_back():
    image = np.full((30, 30, 3), 100, np.uint8)
    for lines, box, name in (
        ([(5, 5, 20, 10)], (4, 4, 21, 11), "union_of_per_line_outer_rings"),
        ([(0, 0, 30, 29)], (0, 0, 30, 29), "merged_block_outer_ring"),
        ([(0, 0, 30, 30)], (0, 0, 30, 30), "block_interior"),
    ):
        colour, n, sampled = imaging.block_colour(image, lines, box, box, 3)
        assert sampled == name and colour.tolist() == [100] * 3 and n >= 8
    assert imaging.crop_colour(image, (40, 40, 50, 50)).tolist() == [255.0] * 3
    image[0] = 7
    assert imaging.pixel_at(image, 3, -5).tolist() == [7, 7, 7] and imaging.around_colour(image, (10, 10, 20, 20)).tolist() == [100.0] * 3
    framed = imaging.outlined(image, [(5, 5, 15, 15)], [imaging.ERASED])
    assert (framed[5, 5:15] == imaging.ERASED).all() and (framed[8, 8] == 100).all()


def test_png_round_trip(spark):
    import struct
    import zlib

    from vellumine.sources import png

    rng = np.random.default_rng(2)
    pixels, alpha = rng.integers(0, 256, (13, 7, 3), np.uint8), rng.integers(0, 256, (13, 7), np.uint8)
    for a in (None, alpha):
        got, shown = png.decoded(png.encoded(pixels, a))
        assert (got == pixels).all() and (shown is None if a is None else (shown == a).all())
    # Every filter type, by the definition: what is stored is the difference from the guess.
    for kind in range(5):
        for n, colour in ((1, 0), (3, 2), (2, 4), (4, 6)):
            raw = rng.integers(0, 256, (5, 4, n), np.uint8).reshape(5, -1).astype(int)
            rows = b""
            for y in range(5):
                rows += bytes([kind])
                for x in range(raw.shape[1]):
                    left = raw[y, x - n] if x >= n else 0
                    up = raw[y - 1, x] if y else 0
                    corner = raw[y - 1, x - n] if y and x >= n else 0
                    p = left + up - corner
                    paeth = min((abs(p - v), k, v) for k, v in enumerate((left, up, corner)))[2]
                    rows += bytes([(raw[y, x] - (0, left, up, (left + up) // 2, paeth)[kind]) % 256])
            head = struct.pack(">IIBBBBB", 4, 5, 8, colour, 0, 0, 0)
            parts = [(b"IHDR", head), (b"IDAT", zlib.compress(rows)), (b"IEND", b"")]
            data = png.SIGNATURE + b"".join(struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b)) for k, b in parts)
            got, shown = png.decoded(data)
            want = raw.reshape(5, 4, n)
            assert (got[..., ::-1] == (want[..., :3] if n > 2 else want[..., :1])).all() and (shown is None or (shown == want[..., -1]).all())
    files = spark.createDataFrame([("a", bytearray(png.encoded(pixels, alpha))), ("b", bytearray(b"no image"))], "path string, content binary")
    found = {r.path: r for r in png.images(files).collect()}
    assert (found["a"].width, found["a"].height, bytes(found["a"].alpha)) == (7, 13, alpha.tobytes()) and "not a PNG" in found["b"].error
    back = png.files(png.images(files.where("path = 'a'")).selectExpr("1 AS page", "width", "height", "pixels", "alpha")).first()
    assert (png.decoded(bytes(back.content))[0] == pixels).all()


def test_retries_by_message_and_thinking():
    from vellumine.plans import providers

    def failing(times, message):
        calls = []

        def send(request):
            calls.append(request)
            if len(calls) <= times:
                raise ValueError(message)
            return providers.Reply("ok")

        return send, calls

    waits = []
    send, calls = failing(2, "Fetch failed: 503")
    assert providers.retried_by_message(send, pause=waits.append)("x").content == "ok" and waits == [1.0, 2.0]
    for times, message, tried in ((3, "timed out", 3), (1, "wrong key", 1)):
        send, calls = failing(times, message)
        with pytest.raises(ValueError):
            providers.retried_by_message(send, pause=waits.append)("x")
        assert len(calls) == tried
    assert providers.with_thinking({"a": 1}, "deepseek", False) == {"a": 1, "thinking": {"type": "disabled"}}
    assert providers.with_thinking({"a": 1}, "other", True) == {"a": 1, "enable_thinking": True}
    assert providers.with_thinking({"a": 1}, "other", None) == {"a": 1}
