import pytest
from pyspark.sql import functions as F

from vellumine.functions import geometry as G
from vellumine.functions import text as T
from vellumine.plans import config, providers


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "x string").select(make(F.col("x")).alias("y")).first().y


def test_page_spec(spark):
    assert one(spark, "6, 5-6,8", T.page_spec) == [5, 6, 8]
    for bad in ("6-5", "0", "a", ""):
        with pytest.raises(Exception):
            one(spark, bad, T.page_spec)


def test_numbers_and_words(spark):
    assert one(spark, "1. 1,234 b72 3.5\n 12. x9", T.numbers) == ["1234", "2", "3.5"]
    assert one(spark, "2. Don’t stop 12 DON'T", T.word_set) == ["don't", "stop", "12"]
    assert one(spark, "3. “A” \n\t b’s ", T.normalised) == '"a" b\'s'


def test_slug_and_labels(spark):
    assert one(spark, "beast academy math guide 3A", T.slug) == "beast_academy_math_guide_3A"
    assert one(spark, "._É té!", T.slug) == "É_té"
    assert one(spark, "1", lambda x: T.range_label(F.array(*map(F.lit, (3, 1, 2, 7, 9, 10))))) == "1-3_7_9-10"


def test_grounding(spark):
    text = "<|ref|>A\nb<|/ref|> <|det|>[[1,2,30,40],[5,5,5,9]]<|/det|><|ref|>c<|/ref|><|det|>oops<|/det|>"
    found = one(spark, text, T.grounded_regions)
    assert [r.text for r in found] == ["A\nb", "c"]
    assert one(spark, found[0].box, T.lenient_boxes) == [[1.0, 2.0, 30.0, 40.0]]
    assert one(spark, "oops", T.strict_boxes) is None


def test_json_scanners():
    assert T.first_json_object('x {bad} {"a": {"b": 1}} y') == '{"a": {"b": 1}}'
    assert T.first_json_object("[1] {") is None
    assert T.uncommented('{"a": "//no", /* x\n */ "b": 1} // y') == '{"a": "//no",     \n    "b": 1}     '
    with pytest.raises(ValueError):
        T.uncommented("/* open")


def test_matching_interval():
    assert T.matching_interval("abcdef", "cde") == (2, 5, 1.0)
    assert T.matching_interval("abcdefgh", "abcdxx") is None
    assert T.matching_interval("abcdefgh", "abcdex") == (0, 5, 5 / 6)
    assert T.matching_interval("", "a") is None


def test_wrapping():
    assert T.wrapped("one two three", len, 7, True) == ["one two", "three"]
    assert T.wrapped("abcdef\ng", len, 4, False) == ["abcd", "ef", "g"]


def test_boxes(spark):
    box = lambda *x: F.array(*[F.lit(float(v)) for v in x])
    value = lambda c: spark.range(1).select(c.alias("y")).first().y
    assert value(G.touch(box(0, 0, 50, 10), box(60, 0, 90, 10)))
    assert not value(G.touch(box(0, 0, 50, 10), box(300, 500, 350, 510)))
    assert value(G.to_pixels(box(500.5, 0, 500.5, 1), F.lit(1000), F.lit(100))) == [500, 0, 501, 1]
    assert value(G.expanded(box(1, 5, 990, 999), 8)) == [0.0, 0.0, 998.0, 1000.0]
    assert value(G.category(F.lit("12"), box(490, 950, 510, 970))) == "page_number"
    assert value(G.category(F.lit("x"), box(10, 900, 300, 970))) == "caption"
    spans = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in ((0, 4), (2, 6), (8, 99))])
    assert value(G.covered(F.lit(10), spans)) == 0.8


def test_config(tmp_path):
    path = tmp_path / "c.jsonc"
    path.write_text('{"ignore": "true", "n": 3 /* three */}')
    loaded = config.load(path, {"ignore", "n"})
    with pytest.raises(config.ConfigError):
        config.strict_flag(loaded, "ignore")
    with pytest.raises(config.ConfigError):
        config.load(path, {"n"})
    with pytest.raises(config.ConfigError):
        config.project_path("../x", tmp_path, "path")
    assert config.merged_rules({"a": 1, "b": {"c": 2, "d": 3}}, {"b": {"c": 5}}) == {"a": 1, "b": {"c": 5, "d": 3}}
    assert config.Artefacts.of("x/a b.pdf", tmp_path).page("ocr", 7) == tmp_path / "a_b/ocr/pages/page-007.json"


def test_retries(spark):
    calls = []

    def flaky(request):
        calls.append(request)
        if len(calls) < 3:
            raise providers.CallError("busy", 503)
        return providers.Reply("done")

    assert providers.retried(flaky, pause=lambda s: None)("x").content == "done" and len(calls) == 3
    with pytest.raises(providers.CallError):
        providers.retried(lambda r: (_ for _ in ()).throw(providers.CallError("no", 400)), pause=lambda s: None)("x")
    rows = providers.called(spark.createDataFrame([(1, "a")], "id int, q string"), "q", lambda: providers.stub, "p", "m").collect()
    assert rows[0].call.content == "A" and rows[0].call.error is None


def test_typesetting():
    from vellumine.functions import typesetting as ts

    measure = lambda x, size: len(x) * size * 0.5
    assert ts.grid(1.0, 1.2, 0.05) == [1.0, 1.05, 1.1, 1.15, 1.2] and ts.grid(11, 11, -0.5) == [11]
    rect, size, lines, ratio = ts.fitted("one two three", measure, (100, 100, 160, 130), (0, 0, 400, 400), 11.0)
    assert size == 11.0 and ratio <= 1 and " ".join(lines) == "one two three" and rect[2] - rect[0] >= 60
    assert ts.container((0, 0, 50, 10), (0, 0, 400, 400), 1.0)[0] == 6.0
    size, lines, height = ts.shrunk("x" * 100, measure, (0, 0, 50, 30), 11.0)
    assert size == 7.0 and height > 30


def test_bubble():
    import numpy as np

    from vellumine.functions import imaging

    image = np.full((100, 120, 3), 90, np.uint8)
    image[20:60, 30:90] = 250
    image[35:40, 50:70] = 0
    white = np.array([250, 250, 250], np.uint8)
    mask, reason = imaging.closed_bubble(image, (44, 28, 76, 46), white, of_image=0.5)
    assert reason == "closed_uniform_component" and mask.sum() == 40 * 60 - 4 and mask[37, 60]
    clean, _, blocks, _ = imaging.erase_blocks(image, [[48, 33, 72, 42]], distance=12.0, shrink=2)
    assert blocks[0]["reason"] == "bubble_too_large_relative_to_image" and (clean[33:42, 48:72] == 250).all()
    assert imaging.closed_bubble(np.full((50, 50, 3), 250, np.uint8), (10, 10, 20, 20), white)[1] == "component_touches_image_edge"
    plus = np.array([[1, 0], [0, 1]], bool)
    assert len(imaging.components(plus)) == 1 and len(imaging.components(plus, diagonal=False)) == 2
