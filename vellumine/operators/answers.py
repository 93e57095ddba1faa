"""Model answers (texts that hold a JSON object somewhere) as typed columns.

``with_objects`` finds the object of each answer, in one pass of Python.  The
functions take such an object and give a struct with an ``error`` that is null
where the answer keeps the rules; otherwise it names the first rule that is
broken and the other fields are null.  Nothing is raised, so one bad answer
does not end a job.  Objects are read as variants.

A text field that is missing is empty; one that is no text is taken as its JSON
text (null as ``None``, as the record format has it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumine import schemas
from vellumine.functions import text as T
from vellumine.functions.text import stripped
from vellumine.operators import rules

def with_objects(df: DataFrame, **contents: Column) -> DataFrame:
    """``df`` with a column for each content: its first JSON object, null where there is none."""
    return df.withColumns({name: T.json_object(content) for name, content in contents.items()})


def _let(value: Column, use) -> Column:
    """``use(value)``, with ``value`` worked out once a row, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _object(found: Column) -> Column:
    return F.try_parse_json(found)


def _items(value: Column, name: str) -> Column:
    """The array of a field, null where it is none."""
    return F.try_variant_get(value, f"$.{name}", "array<variant>")


def _is_object(item: Column) -> Column:
    return F.coalesce(F.schema_of_variant(item).startswith("OBJECT"), F.lit(False))


def _text(item: Column, name: str) -> Column:
    found = F.try_variant_get(item, f"$.{name}", "variant")
    shown = F.coalesce(F.try_variant_get(item, f"$.{name}", "string"), F.when(F.is_variant_null(found), F.lit("None")))
    return stripped(F.coalesce(shown, F.to_json(found), F.lit("")))


def _typed(items: Column, **fields) -> Column:
    """Whether each item is an object (``ok``), and its fields."""
    return F.transform(items, lambda e: F.struct(_is_object(e).alias("ok"), *[f(e).alias(n) for n, f in fields.items()]))


def _texts(*names: str) -> dict:
    return {n: lambda e, n=n: _text(e, n) for n in names}


def _fields(items: Column, *names: str) -> Column:
    return F.transform(items, lambda e: F.struct(*[e[n].alias(n) for n in names]))


def _whole(item: Column, name: str) -> Column:
    """A field as an integer: numbers are cut, texts have to be whole numbers."""
    kind = F.schema_of_variant(F.try_variant_get(item, f"$.{name}", "variant"))
    text = F.trim(F.try_variant_get(item, f"$.{name}", "string"))
    number = F.try_variant_get(item, f"$.{name}", "double").cast("long")
    return F.when(kind.isin("NULL", "VOID"), F.lit(None)).when(kind == "STRING", F.when(F.regexp_like(text, F.lit(r"^[+-]?\d+$")), text.try_cast("long"))).otherwise(number)


def _first(items: Column, message) -> Column:
    """The first item's message that is not null; ``message`` takes an item and its number from 1."""
    found = F.transform(items, lambda e, k: message(e, k + 1))
    return F.try_element_at(F.filter(found, lambda m: m.isNotNull()), F.lit(1))


def _firsts(items: Column, key) -> Column:
    """The items whose key no item before them has: of the sorted ones, those that start a key, in their old order."""
    numbered = F.array_sort(F.transform(items, lambda e, k: F.struct(key(e).alias("key"), k.alias("k"), e.alias("e"))))
    starts = lambda n: F.filter(n, lambda x, k: (k == 0) | ~F.get(n, k - 1)["key"].eqNullSafe(x["key"]))
    order = lambda n: F.array_sort(F.transform(starts(n), lambda x: F.struct(x["k"].alias("k"), x["e"].alias("e"))))
    return F.transform(_let(numbered, order), lambda x: x["e"])


def _answer(error: Column, **fields: Column) -> Column:
    return F.struct(*[F.when(error.isNull(), c).alias(n) for n, c in fields.items()], error.alias("error"))


def _numbered(k: Column, what: str, says: str) -> Column:
    return F.concat(F.lit(f"{what} "), k.cast("string"), F.lit(f" {says}"))


def study(found: Column) -> Column:
    """``regions`` (id, type, source_text; trimmed, type in lower case), ``skipped`` (JSON) of a reading."""
    # Nothing is bound by _let here: Spark does not take a Python function out of what is built on that.
    value = _object(found)
    items = _items(value, "regions")
    error = F.coalesce(
        F.when(value.isNull(), "No valid JSON object found").when(items.isNull(), "study JSON must contain a regions array"),
        _first(items, lambda e, k: F.when(~_is_object(e), _numbered(k, "region", "is not an object"))),
    )
    regions = F.transform(items, lambda e: F.struct(_text(e, "id").alias("id"), F.lower(_text(e, "type")).alias("type"), _text(e, "source_text").alias("source_text")))
    skipped = F.try_variant_get(value, "$.skipped", "variant")
    return _answer(error, regions=regions, skipped=F.when(_is_object(skipped), F.to_json(skipped)).otherwise("{}"))


def source_text(regions: Column) -> Column:
    """The regions' source texts, a line each."""
    return F.array_join(F.transform(regions, lambda r: r["source_text"]), "\n")


def translations(found: Column) -> Column:
    """``translations``: text of each id; the last of an id's texts holds, blank ids and texts are errors."""

    def wrong(e: Column, k: Column) -> Column:
        blank = (e["id"] == "") | (e["translation"] == "")
        return F.when(~e["ok"], _numbered(k, "translation", "is not an object")).when(blank, _numbered(k, "translation", "has an empty id or text"))

    def read(value: Column, items: Column) -> Column:
        error = F.coalesce(F.when(value.isNull(), "No valid JSON object found").when(items.isNull(), "translation JSON must contain a translations array"), _first(items, wrong))
        backwards = F.reverse(_fields(items, "id", "translation"))
        return _answer(error, translations=F.map_from_entries(F.reverse(_firsts(backwards, lambda p: p["id"]))))

    fields = _texts("id", "translation")
    return _let(_object(found), lambda value: _let(_typed(_items(value, "translations"), **fields), lambda items: read(value, items)))


def _issue(known: Column, category: Column, why: Column, who: str, lacking: str, region: Column) -> Column:
    return (
        F.when(~known, F.concat(F.lit(f"{who} returned unknown "), region))
        .when(~category.isin(schemas.ISSUE_CATEGORIES), F.concat(F.lit(f"{who} returned invalid category: "), category))
        .when(why == "", F.lit(f"{who} issue is missing {lacking}"))
    )


def verification(found: Column, expected_ids: Column) -> Column:
    """``issues`` (id, category, explanation, suggested_translation), the first of each id and category."""
    names, who = ("id", "category", "explanation", "suggested_translation"), "Translation verifier"

    def wrong(e: Column, k: Column) -> Column:
        bad = _issue(F.array_contains(expected_ids, e["id"]), e["category"], e["explanation"], who, "an explanation", F.concat(F.lit("ID: "), e["id"]))
        return F.when(~e["ok"], f"{who} issue must be an object").otherwise(bad)

    def read(value: Column, items: Column) -> Column:
        error = F.coalesce(F.when(value.isNull(), "No valid JSON object found").when(items.isNull(), f"{who} JSON must contain an issues array"), _first(items, wrong))
        return _answer(error, issues=_firsts(_fields(items, *names), lambda i: F.struct(i["id"], i["category"])))

    return _let(_object(found), lambda value: _let(_typed(_items(value, "issues"), **_texts(*names)), lambda items: read(value, items)))


def chapter_review(found: Column, regions: Column) -> Column:
    """``issues`` (page, id, category, suggested_translation, reason) and ``global_consistency`` of a chapter.

    ``regions`` are the chapter's (page, id).  Issues of other regions are an
    error; findings of consistency keep only the affected regions that are known.
    """
    who, texts = "Chapter review", ("category", "suggested_translation", "reason")
    place = lambda e: F.struct(_whole(e, "page").alias("page"), _text(e, "id").alias("id"))
    narrow = lambda p: [p["page"].cast("int").alias("page"), p["id"].alias("id")]

    def wrong(known: Column, e: Column) -> Column:
        region = F.concat(F.lit("region: page "), e["place"]["page"].cast("string"), F.lit(" "), e["place"]["id"])
        bad = _issue(F.array_contains(known, e["place"]), e["category"], e["reason"], who, "a reason", region)
        return F.when(~e["ok"], f"{who} issue must be an object").when(e["place"]["page"].isNull(), f"{who} issue has an invalid page").otherwise(bad)

    def affected(known: Column, e: Column) -> Column:
        places = _typed(F.coalesce(_items(e, "affected"), F.array().cast("array<variant>")), place=place)
        kept = F.filter(places, lambda a: a["ok"] & F.coalesce(F.array_contains(known, a["place"]), F.lit(False)))
        return F.transform(kept, lambda a: F.struct(*narrow(a["place"])))

    def read(value: Column, known: Column, items: Column, findings: Column) -> Column:
        error = F.coalesce(
            F.when(value.isNull(), "No valid JSON object found").when(items.isNull() | findings.isNull(), f"{who} JSON must contain issues and global_consistency arrays"),
            _first(items, lambda e, k: wrong(known, e)),
            _first(findings, lambda e, k: F.when(~_is_object(e), "Global consistency finding must be an object")),
        )
        issues = F.transform(items, lambda e: F.struct(*narrow(e["place"]), *[e[n].alias(n) for n in texts]))
        consistent = F.transform(findings, lambda e: F.struct(*[_text(e, n).alias(n) for n in ("category", "item", "preferred_translation", "reason")], affected(known, e).alias("affected")))
        return _answer(error, issues=_firsts(issues, lambda i: F.struct(i["page"], i["id"], i["category"])), global_consistency=consistent)

    pairs = F.transform(regions, lambda r: F.struct(r["page"].cast("long").alias("page"), r["id"].alias("id")))
    typed = lambda value: _typed(_items(value, "issues"), place=place, **_texts(*texts))
    return _let(_object(found), lambda value: _let(pairs, lambda known: _let(typed(value), lambda items: _let(_items(value, "global_consistency"), lambda findings: read(value, known, items, findings)))))


def translation_comparison(call: Column, found: Column, expected_ids: Column) -> Column:
    """``available, error, issues`` of a verifier's call record, which may be null, and the object in its content."""
    none = F.array().cast("array<struct<id:string,category:string,explanation:string,suggested_translation:string>>")

    def compared(read: Column) -> Column:
        failed = F.when(F.coalesce(call["error"], F.lit("")) != "", call["error"])
        error = F.when(call.isNotNull(), F.coalesce(failed, F.when(read["error"].isNotNull(), F.concat(F.lit("invalid_translation_verifier_json: "), read["error"]))))
        return F.struct(call.isNotNull().alias("available"), error.alias("error"), F.when(call.isNotNull() & error.isNull(), read["issues"]).otherwise(none).alias("issues"))

    return _let(verification(found, expected_ids), compared)


def study_comparison(primary_found: Column, verifier: Column, verifier_found: Column, threshold: float = 0.97) -> Column:
    """``available, error, text_similarity, primary_region_count, verifier_region_count, needs_human_review`` of two readings' objects; ``verifier`` is a call record."""
    a, b = study(primary_found), study(verifier_found)
    unread = F.coalesce(a["error"], b["error"])
    failed = F.when(F.coalesce(verifier["error"], F.lit("")) != "", verifier["error"])
    error = F.when(verifier.isNotNull(), F.coalesce(failed, F.when(unread.isNotNull(), F.concat(F.lit("invalid_study_json: "), unread))))
    good = verifier.isNotNull() & error.isNull()
    ratio = T.similarity(T.normalised(F.coalesce(source_text(a["regions"]), F.lit(""))), T.normalised(F.coalesce(source_text(b["regions"]), F.lit(""))))
    return F.struct(
        verifier.isNotNull().alias("available"),
        error.alias("error"),
        F.when(good, F.bround(ratio, 4)).alias("text_similarity"),
        F.when(good, F.size(a["regions"])).alias("primary_region_count"),
        F.when(good, F.size(b["regions"])).alias("verifier_region_count"),
        F.when(verifier.isNotNull(), ~good | (ratio < threshold)).alias("needs_human_review"),
    )


def study_output(primary_found: Column, translation: Column, translation_found: Column) -> Column:
    """``regions`` with their translations, ``skipped``, ``error`` and ``reasons`` to review, of the objects of a reading and a translation; ``translation`` is a call record."""
    read, given = study(primary_found), translations(translation_found)
    some = F.coalesce(F.size(read["regions"]) > 0, F.lit(False))
    failed = translation.isNull() | (F.coalesce(translation["error"], F.lit("")) != "")
    texts = F.when(some & ~failed, given["translations"])
    ids = F.array_distinct(F.transform(read["regions"], lambda r: r["id"]))
    same = F.array_sort(ids) == F.array_sort(F.coalesce(F.map_keys(texts), F.array().cast("array<string>")))
    regions = F.transform(read["regions"], lambda r: F.struct(r["id"].alias("id"), r["type"].alias("type"), r["source_text"].alias("source_text"), F.coalesce(F.try_element_at(texts, r["id"]), F.lit("")).alias("translation")))
    grown = F.exists(regions, lambda r: T.suspicious_expansion(r["source_text"], r["translation"]))
    reasons = rules.flags(
        {
            "invalid_study_json": read["error"].isNotNull(),
            "translation_api_error_or_empty": some & failed,
            "invalid_translation_json": some & ~failed & given["error"].isNotNull(),
            "translation_id_mismatch": some & ~same,
            "translation_suspicious_expansion": some & grown,
        }
    )
    unread = F.when(read["error"].isNotNull(), F.concat(F.lit("invalid_study_json: "), read["error"]))
    none = F.array().cast("array<struct<id:string,type:string,source_text:string,translation:string>>")
    return F.struct(F.coalesce(regions, none).alias("regions"), F.coalesce(read["skipped"], F.lit("{}")).alias("skipped"), unread.alias("error"), reasons.alias("reasons"))


def study_reasons(risk: Column, comparison: Column, translation_reasons: Column, verified: Column) -> Column:
    """Why a study page is to be reviewed: flags, the translation's reasons, then what the two verifiers found, each once."""
    said = rules.flags(
        {
            "verifier_api_or_json_error": comparison["available"] & (F.coalesce(comparison["error"], F.lit("")) != ""),
            "primary_verifier_study_text_disagreement": comparison["available"] & (comparison["text_similarity"] < 0.97),
            "translation_verifier_api_or_json_error": F.coalesce(verified["error"], F.lit("")) != "",
            "translation_semantic_issue": F.size(verified["issues"]) > 0,
        }
    )
    return rules.ordered_union(risk, translation_reasons, said)


def exact_reasons(risk: Column, comparison: Column) -> Column:
    """The same for a page that is read exactly; ``comparison`` as :func:`exact_comparison` gives it."""
    said = rules.flags(
        {
            "verifier_api_error": comparison["available"] & (F.coalesce(comparison["error"], F.lit("")) != ""),
            "primary_verifier_text_disagreement": comparison["available"] & (comparison["text_similarity"] < 0.995),
            "primary_verifier_numeric_count_disagreement": comparison["available"] & (F.size(comparison["numeric_count_differences"]) > 0),
        }
    )
    return rules.ordered_union(risk, said)


def exact_comparison(primary: Column, verifier: Column, threshold: float = 0.995) -> Column:
    """Similarity, numbers on one side only, and numbers whose counts differ (token, primary, verifier), of two exact readings."""
    a, b = F.coalesce(primary["content"], F.lit("")), F.coalesce(verifier["content"], F.lit(""))
    x, y = T.numbers(a), T.numbers(b)
    count = lambda tokens, t: F.size(F.filter(tokens, lambda u: u == t))
    counted = F.transform(F.array_sort(F.array_union(x, y)), lambda t: F.struct(t.alias("token"), count(x, t).alias("primary"), count(y, t).alias("verifier")))
    differ = F.filter(counted, lambda c: c["primary"] != c["verifier"])
    ratio = T.similarity(T.normalised(a), T.normalised(b))
    given = verifier.isNotNull()
    wrong = F.coalesce(verifier["error"], F.lit("")) != ""
    return F.struct(
        given.alias("available"),
        verifier["error"].alias("error"),
        F.when(given, F.bround(ratio, 4)).alias("text_similarity"),
        F.when(given, F.array_sort(F.array_except(x, y))).alias("primary_only_numbers"),
        F.when(given, F.array_sort(F.array_except(y, x))).alias("verifier_only_numbers"),
        F.when(given, differ).alias("numeric_count_differences"),
        F.when(given, wrong | (ratio < threshold) | (F.size(differ) > 0)).alias("needs_human_review"),
    )
