"""Model answers against the rules written out in plain Python."""

import difflib
import json
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from vellumine import schemas
from vellumine.operators import answers

NOISE = ["", "Here it is:\n```json\n", "{not json} "]


def answered(spark, rows, schema, column):
    df = spark.createDataFrame(rows, schema)
    content = F.col("c") if "c" in df.columns else F.col("call.content")
    df = answers.with_objects(df, found=content).select("k", column.alias("a")).orderBy("k")
    return [r.a for r in df.collect()]


def stripped(x):
    return str(x).strip()


def first_object(text):
    decoder = json.JSONDecoder()
    for m in re.finditer(r"\{", text):
        try:
            value = decoder.raw_decode(text, m.start())[0]
        except ValueError:
            continue
        if isinstance(value, dict):
            return value
    return None


def study(text):
    value = first_object(text)
    if value is None:
        return "No valid JSON object found"
    if not isinstance(value.get("regions"), list):
        return "study JSON must contain a regions array"
    for k, r in enumerate(value["regions"], 1):
        if not isinstance(r, dict):
            return f"region {k} is not an object"
    out = [(stripped(r.get("id", "")), stripped(r.get("type", "")).lower(), stripped(r.get("source_text", ""))) for r in value["regions"]]
    return out, value["skipped"] if isinstance(value.get("skipped"), dict) else {}


def test_study_answers(spark):
    bodies = [
        {"regions": [{"id": " r1 ", "type": "Dialogue", "source_text": "\n a 　"}, {"id": 7, "type": None}], "skipped": {"n": 2}},
        {"regions": [], "skipped": [1]},
        {"regions": "x"},
        {"regions": [{"id": "a"}, "b", 3]},
        {"other": 1},
    ]
    texts = [n + json.dumps(b, ensure_ascii=False) + " end" for n in NOISE for b in bodies] + ["", "{}", "no object", '{"regions": [{"id": "a", "id": "b"}]}']
    found = answered(spark, list(enumerate(texts)), "k int, c string", answers.study(F.col("found")))
    for text, got in zip(texts, found, strict=True):
        want = study(text)
        if isinstance(want, str):
            assert got.error == want and got.regions is None
        else:
            assert got.error is None and [tuple(r) for r in got.regions] == want[0] and json.loads(got.skipped) == want[1]
    assert answered(spark, [(0, None)], "k int, c string", answers.study(F.col("found")))[0].error == "No valid JSON object found"


def test_translation_answers(spark):
    item = lambda i, t: {"id": i, "translation": t}
    cases = [
        ({"translations": [item("a", "x"), item(" b ", "y"), item("a", " z ")]}, {"a": "z", "b": "y"}),
        ({"translations": []}, {}),
        ({"translations": {}}, "translation JSON must contain a translations array"),
        ({"translations": [item("a", "x"), 3]}, "translation 2 is not an object"),
        ({"translations": [item("a", " ")]}, "translation 1 has an empty id or text"),
        ({"translations": [item("", "x"), 3]}, "translation 1 has an empty id or text"),
    ]
    found = answered(spark, [(k, json.dumps(b)) for k, (b, _) in enumerate(cases)], "k int, c string", answers.translations(F.col("found")))
    for (_, want), got in zip(cases, found, strict=True):
        assert (got.error if isinstance(want, str) else got.translations) == want


def test_verifications(spark):
    issue = lambda i, c="name", e="why", s="": {"id": i, "category": c, "explanation": e, "suggested_translation": s}
    cases = [
        ({"issues": [issue("a", s=" t "), issue("a", e="again"), issue("a", "number"), issue("b")]}, [("a", "name", "why", "t"), ("a", "number", "why", ""), ("b", "name", "why", "")]),
        ({"issues": None}, "Translation verifier JSON must contain an issues array"),
        ({"issues": [issue("a"), 5]}, "Translation verifier issue must be an object"),
        ({"issues": [issue("z", "bad")]}, "Translation verifier returned unknown ID: z"),
        ({"issues": [issue("a", "bad", "")]}, "Translation verifier returned invalid category: bad"),
        ({"issues": [issue("a", e="  ")]}, "Translation verifier issue is missing an explanation"),
    ]
    rows = [(k, json.dumps(b), ["a", "b"]) for k, (b, _) in enumerate(cases)]
    found = answered(spark, rows, "k int, c string, ids array<string>", answers.verification(F.col("found"), F.col("ids")))
    for (_, want), got in zip(cases, found, strict=True):
        assert got.error == want if isinstance(want, str) else [tuple(i) for i in got.issues] == want
    calls = [(0, None), (1, ("ok", None, json.dumps(cases[0][0]))), (2, ("x", "timeout", "")), (3, ("x", None, "{}"))]
    rows = [(k, None if c is None else {"error": c[1], "content": c[2]}, ["a", "b"]) for k, c in calls]
    found = answered(spark, rows, "k int, call struct<error:string,content:string>, ids array<string>", answers.translation_comparison(F.col("call"), F.col("found"), F.col("ids")))
    assert [(x.available, x.error, len(x.issues)) for x in found] == [(False, None, 0), (True, None, 3), (True, "timeout", 0), (True, "invalid_translation_verifier_json: Translation verifier JSON must contain an issues array", 0)]


def test_chapter_reviews(spark):
    issue = lambda p, i, c="name", r="why": {"page": p, "id": i, "category": c, "reason": r, "suggested_translation": "s"}
    finding = {"category": "term", "item": "x", "preferred_translation": "y", "reason": "z", "affected": [{"page": "1", "id": "a"}, {"page": "q", "id": "a"}, {"page": 9, "id": "a"}, 4, {"page": 2.0, "id": "b"}]}
    cases = [
        ({"issues": [issue(1, "a"), issue("1", "a"), issue(2, "b"), issue(1, "a", "number")], "global_consistency": [finding, {}]}, None),
        ({"issues": []}, "Chapter review JSON must contain issues and global_consistency arrays"),
        ({"issues": [issue("x", "a")], "global_consistency": []}, "Chapter review issue has an invalid page"),
        ({"issues": [issue(3, "a")], "global_consistency": []}, "Chapter review returned unknown region: page 3 a"),
        ({"issues": [issue(1, "a", "odd")], "global_consistency": []}, "Chapter review returned invalid category: odd"),
        ({"issues": [issue(1, "a", r="")], "global_consistency": []}, "Chapter review issue is missing a reason"),
        ({"issues": [], "global_consistency": [1]}, "Global consistency finding must be an object"),
    ]
    rows = [(k, json.dumps(b), [(1, "a"), (2, "b")]) for k, (b, _) in enumerate(cases)]
    found = answered(spark, rows, "k int, c string, r array<struct<page:int,id:string>>", answers.chapter_review(F.col("found"), F.col("r")))
    assert [x.error for x in found] == [w for _, w in cases]
    assert [(i.page, i.id, i.category) for i in found[0].issues] == [(1, "a", "name"), (2, "b", "name"), (1, "a", "number")]
    assert [[tuple(a) for a in g.affected] for g in found[0].global_consistency] == [[(1, "a"), (2, "b")], []]


def test_comparisons_and_outputs(spark):
    reading = lambda *t: json.dumps({"regions": [{"id": f"r{k}", "type": "other", "source_text": x} for k, x in enumerate(t)]})
    given = lambda **t: json.dumps({"translations": [{"id": i, "translation": x} for i, x in t.items()]})
    long = "x" * 15
    cases = [  # primary, verifier, translation
        (reading("one two", "three"), (reading("one two", "three"), None), (given(r0="A", r1="B"), None)),
        (reading("one two", "three"), (reading("quite another text"), None), (given(r0="A"), None)),
        (reading(long), ("", "down"), (given(r0="y" * 96), None)),
        (reading("a"), ("no json", None), ("{}", None)),
        (reading("a"), None, None),
        (reading(), None, None),
        ("no json", (reading("a"), None), None),
    ]
    call = lambda c: None if c is None else {"content": c[0], "error": c[1]}
    rows = [(k, call((p, None)), call(v), call(t), ["flag"] if k == 0 else []) for k, (p, v, t) in enumerate(cases)]
    kind = "struct<content:string,error:string>"
    df = spark.createDataFrame(rows, f"k int, primary {kind}, verifier {kind}, translation {kind}, risk array<string>")
    df = answers.with_objects(df, **{c[0]: F.col(f"{c}.content") for c in ("primary", "verifier", "translation")})
    p, v, t = (F.col(c) for c in "pvt")
    none = answers.translation_comparison(F.lit(None).cast(kind), F.lit(None).cast("string"), F.array(F.lit("r0")))
    out = df.select("k", answers.study_comparison(p, F.col("verifier"), v).alias("c"), answers.study_output(p, F.col("translation"), t).alias("o"), "risk")
    out = out.withColumn("why", answers.study_reasons(F.col("risk"), F.col("c"), F.col("o.reasons"), none))
    found = out.orderBy("k").collect()
    assert [(x.c.available, x.c.needs_human_review) for x in found] == [(True, False), (True, True), (True, True), (True, True), (False, None), (False, None), (True, True)]
    ratio = difflib.SequenceMatcher(None, "one two three", "quite another text").ratio()
    assert found[1].c.text_similarity == round(ratio, 4) and (found[1].c.primary_region_count, found[1].c.verifier_region_count) == (2, 1)
    assert found[2].c.error == "down" and found[3].c.error.startswith("invalid_study_json: ")
    assert [x.o.reasons for x in found] == [[], ["translation_id_mismatch"], ["translation_suspicious_expansion"], ["invalid_translation_json", "translation_id_mismatch"], ["translation_api_error_or_empty", "translation_id_mismatch"], [], ["invalid_study_json"]]
    assert [[r.translation for r in x.o.regions] for x in found] == [["A", "B"], ["A", ""], ["y" * 96], [""], [""], [], []]
    assert found[0].why == ["flag"] and found[1].why == ["translation_id_mismatch", "primary_verifier_study_text_disagreement"] and "verifier_api_or_json_error" in found[2].why


def test_exact_comparison(spark):
    cases = [("a 1,000 b 2 2", ("a 1000 b 2", None)), ("1. one 5", ("one 5", None)), ("x", ("x", "late")), ("x", None)]
    kind = "struct<content:string,error:string>"
    rows = [(k, {"content": p, "error": None}, None if v is None else {"content": v[0], "error": v[1]}) for k, (p, v) in enumerate(cases)]
    df = spark.createDataFrame(rows, f"k int, p {kind}, v {kind}").select("k", answers.exact_comparison(F.col("p"), F.col("v")).alias("c"))
    found = [r for r in df.withColumn("why", answers.exact_reasons(F.array(F.lit("f")), F.col("c"))).orderBy("k").collect()]
    assert [tuple(d) for d in found[0].c.numeric_count_differences] == [("2", 2, 1)] and found[0].c.primary_only_numbers == []
    assert found[1].c.text_similarity == 1.0 and not found[1].c.needs_human_review and found[1].why == ["f"]
    assert found[2].c.needs_human_review and found[2].why == ["f", "verifier_api_error"] and found[3].c.available is False and found[3].why == ["f"]
    assert "primary_verifier_numeric_count_disagreement" in found[0].why


@pytest.mark.parametrize("category", schemas.ISSUE_CATEGORIES)
def test_every_category_is_known(spark, category):
    body = json.dumps({"issues": [{"id": "a", "category": category, "explanation": "e"}]})
    assert answered(spark, [(0, body, ["a"])], "k int, c string, i array<string>", answers.verification(F.col("found"), F.col("i")))[0].error is None


@pytest.mark.parametrize("name", ["translation_answers", "verifier_issues", "study_answers", "chapter_issues"])
def test_an_answer_is_worked_out_once(spark, sf, name):
    """The plan parses an answer in one place (a reading in one step); it was written out again for each field, item and filter."""
    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter ((size(" not in plan and sum("parseJson" in line for line in plan.splitlines()) == 1
    assert plan.count("parseJson") == 1 or name == "study_answers"
