"""Settings, rules, tools, reviewers, line protocols and stages."""

import dataclasses
import json
import sys

import pytest

from vellumine.plans import bridge, review, settings, stages, tools
from vellumine.plans.config import ConfigError
from vellumine.plans.rules import LEGACY, WRITER, legacy_rules, writer_rules


def test_rules_keep_their_ranges():
    assert writer_rules() == WRITER and legacy_rules({}) == LEGACY and writer_rules() is not WRITER
    given = writer_rules({"font_sizes": {"dialogue": 20}, "line_spacing": 2})
    assert given["font_sizes"]["dialogue"] == 20 and given["font_sizes"]["heading"] == 14.0 and WRITER["font_sizes"]["dialogue"] == 11.0
    assert legacy_rules({"background_strategy": "nearby_median"})["background_strategy"] == "opencv_inpaint"
    for bad in ({"x": 1}, {"line_spacing": 0.5}, {"font_size_step": 0}, {"minimum_font_size": "a"}, {"minimum_write_match_coverage": 1.5}):
        with pytest.raises(ConfigError):
            writer_rules(bad)
    for bad in ({"maximum_width_expansion": 1.6}, {"ai_check": "all"}, {"unmatched_action": "write"}, {"erase_inpaint_method": "x"}, {"geometry_reference_minimum_regions": 2}, {"erase_render_long_edge": 511}, {"erase_dilate_iterations": -1}):
        with pytest.raises(ConfigError):
            legacy_rules(bad)


PROFILES = {"a": {"provider": "p", "model": "m", "api_key_name": "k", "chat_endpoint": "https://x", "responses_endpoint": "https://y", "max_tokens": 2048}}


def test_settings(tmp_path):
    of = settings.ReviewSettings.of
    assert of({}).image_mode == "on_demand" and of({"codex_review": {"include_image": True}}, older=True).image_mode == "always"
    for bad in ({"extra": 1}, {"model": " "}, {"reasoning_effort": "max"}, {"timeout_seconds": 0}, {"timeout_seconds": True}, {"image_mode": "x"}, {"require_chatgpt_login": "yes"}, {"include_image": True}, {"exclude_back_matter": 1}):
        with pytest.raises(ConfigError):
            of({"codex_review": bad})
    with pytest.raises(ConfigError):
        of({"codex_review": {"include_image": True, "image_mode": "never"}}, older=True)
    roles = dict.fromkeys(settings.ROLES, "a")
    found = settings.profiles_by_role({"model_profiles": PROFILES, "model_usage": roles}, {"k": "secret"})
    assert found["primary_ocr"].model == "m" and "secret" not in repr(found["primary_ocr"]) and found["primary_ocr"].api_key == "secret"
    for change in ({"api_key_name": "z"}, {"chat_endpoint": "http://x"}, {"max_tokens": 10}, {"enable_thinking": "no"}, {"model": ""}, {"extra": 1}):
        with pytest.raises(ConfigError):
            settings.profiles_by_role({"model_profiles": {"a": PROFILES["a"] | change}, "model_usage": roles}, {"k": ""})
    with pytest.raises(ConfigError, match="unknown profile"):
        settings.profiles_by_role({"model_profiles": PROFILES, "model_usage": roles}, {"k": ""}, {"ocr_verifier": "b"})
    config = tmp_path / "config" / "pipeline.json"
    config.parent.mkdir()
    config.write_text('{ // comment\n "pdf": "b.pdf", "workers": 3, "verify": "never"}')
    run = settings.RunSettings.load(config, tmp_path)
    assert (run.workers, run.verify, run.long_edge, run.pdf) == (3, "never", 2048, tmp_path / "b.pdf")
    assert settings.discovered(["--config", "x"], tmp_path).name == "x" and settings.discovered(["--config=y"], tmp_path).name == "y" and settings.discovered([], tmp_path) == config
    for bad in ({"workers": 5}, {"api_keys": {}}, {"translation": {"provider": "x"}}, {"resume": "no"}, {"pdf": "../x.pdf"}):
        config.write_text(json.dumps(bad))
        with pytest.raises(ConfigError):
            settings.RunSettings.load(config, tmp_path)
    back = settings.BackfillSettings.of({"pdf_backfill": {"layout_overrides_filename": "l.json"}}, tmp_path, tmp_path).of_pages("1-3")
    assert back.names["plan_filename"].name == "pdf_backfill_plan-1-3.json" and back.names["layout_overrides_filename"].name == "l.json" and back.names["human_translation_overrides_filename"] is None
    assert settings.WriterSettings.of({"pdf_writer": {"rules": {"line_spacing": 1.5}}}, tmp_path).rules["line_spacing"] == 1.5
    assert settings.page_document(None, "p/page-0001.md").name == "page-0001.json"
    with pytest.raises(ConfigError):
        settings.page_document("a", "b")


def test_tools(tmp_path):
    for name in ("pdftoppm", "pdfinfo"):
        (tmp_path / name).write_text("")
    told = lambda command: "-scale-to -singlefile" if command[0].startswith(str(tmp_path)) else ""
    assert tools.rasteriser(path=str(tmp_path), run=told) == str(tmp_path / "pdftoppm")
    assert tools.page_counter(str(tmp_path / "pdftoppm")) == str(tmp_path / "pdfinfo")
    assert tools.pdf_tools(str(tmp_path / "pdftoppm"), find=lambda n: None)[1].endswith("pdfinfo")
    for wrong in (lambda: tools.rasteriser(path=str(tmp_path), run=lambda c: "-scale-to"), lambda: tools.pdf_tools(None, find=lambda n: None), lambda: tools.font([tmp_path / "x"]), lambda: tools.command("/no/such"), lambda: tools.libraries("no_such_library"), lambda: tools.page_counter("/x/y", find=lambda n: None), lambda: tools.login_status(sys.executable, "nobody")):
        with pytest.raises(tools.Absent):
            wrong()
    assert tools.font([tmp_path / "x", tmp_path / "pdfinfo"]).name == "pdfinfo" and tools.libraries("json")[0] is json
    assert tools.environment_without(["A"], {"A": "1", "B": "2"}) == {"B": "2"} and not tools.renders_pages("/no/such")


ECHO = "import sys, json\nfor l in sys.stdin:\n r = json.loads(l)\n print(json.dumps({'id': r['id'] + r.get('off', 0), 'ok': r.get('fine', True), 'result': r.get('result', {'got': r.get('text')}), 'error': 'no'}), flush=True)\n if r.get('end'): break\n"


def test_line_bridge():
    one = bridge.LineBridge([sys.executable, "-c", ECHO], seconds=20)
    assert one.request({"text": "a", "end": True}) == {"got": "a"}
    one.child.process.wait(10)
    assert one.request({"text": "b"}) == {"got": "b"}  # started again
    for bad, message in (({"off": 1}, "another request"), ({"fine": False}, "no"), ({"result": 3}, "no object")):
        with pytest.raises(bridge.BridgeError, match=message):
            one.request(bad)
    one.close()
    slow = bridge.LineBridge([sys.executable, "-c", "import time; time.sleep(30)"], seconds=0.3)
    with pytest.raises(TimeoutError):
        slow.request({})
    assert slow.child is None and bridge.bridge(["x"]) is bridge.bridge(["x"])
    with pytest.raises(bridge.BridgeError):
        bridge.LineBridge(["/no/such/program"]).request({})


def test_served_requests_and_credentials(tmp_path):
    actions = {"translate": lambda r: {"text": bridge.translate_request(r)["text"].upper()}, "health": lambda r: {}}
    lines = ['{"id": 1, "action": "translate", "text": "a", "target_lang": "ZH"}', "", '{"id": 2, "action": "translate", "text": " "}', '{"id": 3, "action": "x"}', "no json", "[1]"]
    found = [json.loads(x) for x in bridge.served(lines, actions)]
    assert found[0] == {"id": 1, "ok": True, "result": {"text": "A"}} and [(x["id"], x["ok"]) for x in found[1:]] == [(2, False), (3, False), (None, False), (None, False)]
    data = {"token": "ü", "n": 1}
    assert bridge.decoded_credentials(bridge.encoded_credentials(data)) == data
    with pytest.raises(ValueError):
        bridge.decoded_credentials(bridge.encoded_credentials([1]))
    path = tmp_path / ".env"
    bridge.store_credential(path, "K", "1")
    assert path.read_text() == "K=1\n" and path.stat().st_mode & 0o777 == 0o600
    path.write_bytes(b"A=1\r\nexport K = 2\r\nB=2\r\nK=3\r\n")
    bridge.store_credential(path, "K", "9")
    assert path.read_bytes() == b"A=1\r\nK=9\r\nB=2\r\n"


SERVER = """
import sys, json
def say(**x): print(json.dumps(x), flush=True)
for line in sys.stdin:
    r = json.loads(line)
    m = r.get("method")
    if m == "initialize": say(id=r["id"], result={})
    elif m == "thread/start": say(method="hello", params={}); say(id="s1", method="approve", params={}); say(id=r["id"], result={"thread": {"id": "t1"}})
    elif m == "thread/resume": say(id=r["id"], result={"thread": {"id": "other"}})
    elif m == "turn/start":
        say(method="item/completed", params={"turnId": "u0", "item": {"type": "agentMessage", "text": "stale"}})
        say(id=r["id"], result={"turn": {"id": "u1"}})
        say(method="item/completed", params={"turnId": "u1", "item": {"type": "agentMessage", "text": json.dumps({"asked": r["params"]["input"]})}})
        say(method="thread/tokenUsage/updated", params={"turnId": "u1", "tokenUsage": {"last": {"totalTokens": 5}}})
        say(method="turn/completed", params={"turn": {"id": "u1", "status": r["params"]["effort"]}})
    elif m == "bad": say(id=r["id"], error={"code": 1})
"""


def test_rpc_client():
    with bridge.RpcClient([sys.executable, "-c", SERVER], seconds=20) as client:
        thread = client.thread({})
        turn = client.turn(thread, [{"type": "text"}], {}, "completed")
        assert (turn.thread_id, turn.turn_id, turn.response, turn.usage) == ("t1", "u1", {"asked": [{"type": "text"}]}, {"totalTokens": 5})
        for wrong in (lambda: client.thread({}, resume="t9"), lambda: client.request("bad", {}), lambda: client.turn(thread, [], {}, "failed")):
            with pytest.raises(bridge.BridgeError):
                wrong()
        with pytest.raises(TimeoutError):
            client.request("silent", {}, 0.2)


def page_files(folder, page=7, picture=True, **change):
    regions = [{"id": "a", "type": "other", "source_text": "x\r\ny", "translation": "T1"}, {"id": "b", "type": "other", "source_text": "z", "translation": "T2"}]
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"page-{page:04d}.json"
    path.write_text(json.dumps({"page": page, "mode": "study", "layout": {"content": ""}, "study": {"regions": regions}} | change))
    if picture:
        path.with_suffix(".png").write_bytes(b"png")
    return path


def decision(own="a", text="N", current="T1", **change):
    return {"page": 7, "id": own, "decision": "replace", "current_translation": current, "final_translation": text, "reason": "r", "confidence": "high", "child_note": ""} | change


def answer(ids=("a", "b"), decisions=(), human=()):
    return {"page": 7, "reviewed_region_ids": list(ids), "decisions": list(decisions), "human_review": [{"page": 7, "id": i, "reason": "r", "evidence_needed": "e", "evidence_type": k} for i, k in human], "summary": f"n{len(ids)}"}


def test_review_in_two_stages(tmp_path):
    inputs = review.load_page(page_files(tmp_path), True)
    assert inputs.regions[0]["source_text"] == "x\ny" and set(inputs.hashes) == {"page-0007.json", "page-0007.png"} and set(inputs.without_image().hashes) == {"page-0007.json"}
    asked = []

    def ask(items, schema):
        asked.append((json.loads(items[0]["text"])["target_region_ids"], len(items), schema["properties"]["decisions"]["items"]["properties"]["id"]["enum"]))
        usage = {"available": True} | dict.fromkeys(review.COUNTERS, 2)
        return (answer(decisions=[decision("b", current="T2")], human=[("a", "image")]) if len(asked) == 1 else answer(["a"], [decision()])), usage

    found, steps, used = review.reviewed(inputs, ask)
    assert asked == [(["a", "b"], 1, ["a", "b"]), (["a"], 2, ["a"])] and used.image_path and [s["name"] for s in steps] == ["text", "image"]
    assert [d["id"] for d in found["decisions"]] == ["a", "b"] and found["human_review"] == [] and found["summary"] == "Text stage: n2 Image stage: n1"
    document = review.result_document(used, found, steps, {"model": "m"}, book=True, thread_id="t")
    assert (document["schema_version"], document["codex"]["thread_id"], document["codex"]["usage"]["total_tokens"], document["inputs"]["region_ids"]) == (5, "t", 4, ["a", "b"])
    alone = review.result_document(used, found, steps, {"model": "m"})
    assert alone["schema_version"] == 4 and alone["codex"]["image_attached"] and len(alone["codex"]["stages"]) == 2
    asked.clear()
    assert review.reviewed(inputs, ask, "never")[1][0]["name"] == "text" and len(asked) == 1
    assert review.reviewed(inputs, review.stub, "always")[1][0]["image_attached"]
    (tmp_path / "page-0007.png").write_bytes(b"other")
    with pytest.raises(review.ReviewError, match="changed"):
        review.unchanged(inputs)
    review.unchanged(inputs, ignore_hashes=True)
    assert review.usage_sum([{"available": True, "total_tokens": 1}, {"available": False}], need_all=True)["available"] is False
    assert review.result_path(inputs.json_path).name == "page-0007-codex-review.json"


def test_answers_that_break_rules(tmp_path):
    inputs = review.load_page(page_files(tmp_path), False)
    bad = [answer(["a"]), answer(["a", "b", "b"]), answer() | {"page": 8}, answer(decisions=[decision(text="T1")]), answer(decisions=[decision(text=" ")]), answer(decisions=[decision(), decision()]), answer(decisions=[decision("z")])]
    bad += [answer(decisions=[decision(**c)]) for c in ({"decision": "discard"}, {"confidence": "sure"}, {"current_translation": "x"}, {"reason": ""}, {"page": 9})] + [answer(human=[("a", "sound")]), answer() | {"decisions": {}}]
    for one in bad:
        with pytest.raises(review.ReviewError):
            review.checked(inputs, one)
    assert review.checked(inputs, answer(decisions=[decision(text=" N ")]))["decisions"][0]["final_translation"] == "N"
    for wanted in ([], ["a", "a"], ["q"]):
        with pytest.raises(review.ReviewError):
            inputs.targets(wanted)
    page_files(tmp_path / "moved", 8, False).rename(tmp_path / "moved" / "page-0009.json")
    with pytest.raises(review.ReviewError, match="of page 9"):
        review.load_page(tmp_path / "moved" / "page-0009.json", False)
    for change in ({"mode": "exact"}, {"study": {"regions": []}}, {"study": {"regions": [{"id": "a", "source_text": "x", "translation": " "}]}}, {"study": {"regions": [3]}}):
        with pytest.raises(review.ReviewError):
            review.load_page(page_files(tmp_path / "bad", **change), False)
    with pytest.raises(review.ReviewError):
        review.load_page(tmp_path / "page-7.json", False)


def test_schemas_and_evidence(tmp_path):
    inputs = review.load_page(page_files(tmp_path), True)
    schema = review.answer_schema(inputs, ["b"])
    assert schema["required"] == ["page", "reviewed_region_ids", "decisions", "human_review", "summary"] and schema["properties"]["page"]["const"] == 7 and not schema["additionalProperties"]
    toc = review.toc_schema(90, [5, 6])
    assert toc["properties"]["entries"]["items"]["properties"]["source_toc_pdf_page"]["enum"] == [5, 6] and toc["properties"]["pdf_page_count"]["const"] == 90
    items = review.toc_items(tmp_path / "b.pdf", 90, [5], [tmp_path / "t.png"], "low")
    assert json.loads(items[0]["text"])["offset_evidence"][0]["toc_pdf_page"] == 5 and items[1]["detail"] == "low"
    text = review.prompt(inputs, ["a"], image_follows=True)
    assert 'Ids to review: ["a"]' in text and '"source_text": "z"' in text and "page-0007.png" in text
    command = review.command_line("tool", "m", "high", inputs, tmp_path / "s", tmp_path / "r")
    assert command[:2] == ["tool", "exec"] and command[-1] == "-" and command[command.index("--image") + 1].endswith(".png")
    assert "--image" not in review.command_line("tool", "m", "high", inputs.without_image(), tmp_path / "s", tmp_path / "r")


def test_stages(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.chdir(tmp_path)
    (tmp_path / "b.pdf").write_bytes(b"%PDF")
    (tmp_path / "config").mkdir()
    config = tmp_path / "config" / "pipeline.json"
    config.write_text(json.dumps({"pdf": "b.pdf"}))
    run = lambda *a, **k: stages.main([*a], tmp_path, spark, **k)
    own = tmp_path / "runs" / "b"
    layout = "<|ref|>x y<|/ref|><|det|>[[100,100,500,200]]<|/det|><|ref|>z<|/ref|><|det|>[[100,300,500,400]]<|/det|>"
    page_files(own / "read" / "pages", 1, False, layout={"content": layout})
    assert run("review") == 2 and "table of contents" in capsys.readouterr().err
    (own / "review").mkdir(parents=True)
    (own / "review" / "book-review-plan.json").write_text(json.dumps({"tasks": [{"task_id": "c1", "pdf_start_page": 1, "pdf_end_page": 1}]}))

    def ask(items, schema):
        found, usage = review.stub(items, schema)
        return found | {"decisions": [decision(page=1)]}, usage

    assert run("finalize") == 2
    assert run("review", "--log-file", "log.txt", reviewer=ask) == 0 and "book=b" in (tmp_path / "log.txt").read_text()
    saved = own / "review" / "c1" / "page-0001-codex-review.json"
    before = saved.read_bytes()
    assert run("review") == 0 and saved.read_bytes() == before  # what is done stays
    assert run("finalize", "--dry-run") == 0 and not (own / "final").exists()
    assert run("finalize") == 0
    final = json.loads((own / "final" / "translation-final.json").read_text())
    assert [(r["id"], r["final_translation"]) for r in final["regions"]] == [("a", "N"), ("b", "T2")] and final["translation_source_counts"] == {"codex_adjudication": 1, "saved_page_translation": 1}
    (own / "overrides").mkdir()
    (own / "overrides" / "layout.json").write_text(json.dumps({"schema_version": 1, "regions": [{"page": 1, "id": "b", "skip": True}]}))
    assert run("write") == 0
    report = json.loads((own / "written" / "writer-report.json").read_text())
    assert report["status_counts"]["skipped_by_override"] == 1 and {r["id"] for r in report["regions"]} == {"a", "b"}
    (own / "overrides" / "layout.json").write_text(json.dumps({"schema_version": 1, "regions": [{"page": 1, "id": "b", "colour": "x"}]}))
    assert run("write") == 2 and "unknown fields" in capsys.readouterr().err
    record = json.loads((own / "read" / "pages" / "page-0001.json").read_text())
    record["study"]["regions"][0]["translation"] = "changed"
    (own / "read" / "pages" / "page-0001.json").write_text(json.dumps(record))
    assert run("finalize") == 2 and "page changed" in capsys.readouterr().err


def test_erase_stage_and_books(spark, tmp_path, monkeypatch):
    import numpy as np

    from vellumine.sources import png

    monkeypatch.chdir(tmp_path)
    (tmp_path / "books").mkdir()
    for name in ("B one.pdf", "a.PDF", "note.txt"):
        (tmp_path / "books" / name).write_bytes(b"")
    assert [a.book for a in stages.books(tmp_path / "books", tmp_path)] == ["a", "B_one"]
    (tmp_path / "books" / "B_one.pdf").write_bytes(b"")
    for wrong in (tmp_path / "books", tmp_path / "books" / "note.txt", tmp_path / "none"):
        with pytest.raises(ConfigError):
            stages.books(wrong, tmp_path)
    (tmp_path / "b.pdf").write_bytes(b"")
    (tmp_path / "c.json").write_text('{"pdf": "b.pdf"}')
    folder = tmp_path / "runs" / "b" / "read" / "pages"
    page_files(folder, 1, False, layout={"content": "<|ref|>x<|/ref|><|det|>[[200,200,600,400]]<|/det|>"})
    image = np.full((100, 100, 3), 220, np.uint8)
    image[25:35, 25:55] = 0
    (folder / "page-0001.png").write_bytes(png.encoded(image))
    assert stages.main(["--config", "c.json", "erase", "--strategy", "block"], tmp_path, spark) == 0
    clean, _ = png.decoded(next((tmp_path / "runs").rglob("erased/pages/*.png")).read_bytes())
    assert (clean == 220).all()
    with pytest.raises(SystemExit):
        stages.parser().parse_args(["erase", "--strategy", "x"])
    assert dataclasses.is_dataclass(stages.Run)
