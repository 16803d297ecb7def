import json

from loomwright.__main__ import main

BLOCK = 'import cadquery as cq\nresult = cq.Workplane("XY").box(52, 34, 9)'


def lines(path, rows):
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))
    return str(path)


def test_list(capsys):
    assert main(["list"]) == 0
    assert "coverage_by_type" in capsys.readouterr().out


def test_stages_from_programs_to_exports(spark, tmp_path, capsys):
    programs = [BLOCK + end for end in ('.faces(">Z").workplane().hole(7)', '.edges("|Z").fillet(3)', "")] * 4 + ["broken ("]
    source = lines(tmp_path / "programs.jsonl", [{"id": f"p{i}", "code": code, "images": ["a.png"]} for i, code in enumerate(programs)])
    said = "Remove the circular hole with a diameter of 7 mm, keeping the rest of the part unchanged."
    answers = lines(tmp_path / "answers.jsonl", [{"sample_id": "v3_delete_p0_0", "answer": said}, "not json"])
    assert main(["stages", source, str(tmp_path / "out"), "--answers", answers, "--report"]) == 0
    assert "| v3_delete | delete_hole | 4 | 4 | 100.0 |" in capsys.readouterr().out
    rows = {r.sample_id: r for r in spark.read.json(str(tmp_path / "out/training")).collect()}
    assert rows["v3_delete_p0_0"].instruction == said and rows["v3_delete_p0_0"].target_code == BLOCK
    chat = spark.read.json(str(tmp_path / "out/chat_sft")).first()
    assert [m.role for m in chat.messages] == ["system", "user", "assistant"]
    full = spark.read.json(str(tmp_path / "out/full_metadata"))
    assert full.filter("fallback_used").count() == len(rows) - 1 and full.filter("original_code = target_code").isEmpty()
    assert json.loads((tmp_path / "out/summary.json").read_text())["leaks"] == 0
    manifest = json.loads((tmp_path / "out/records/_manifest.json").read_text())
    assert manifest["selected_all"] == len(rows) == sum(manifest[f"selected_{s}"] for s in ("train", "val", "test"))
    assert json.loads((tmp_path / "out/pool/_manifest.json").read_text())["v3_delete"] == 8
    assert main(["stages", source, str(tmp_path / "out")]) == 2
    assert main(["stages", source, str(tmp_path / "out"), "--overwrite-below", str(tmp_path), "--branches", "v3_delete"]) == 0
    assert {r.branch for r in spark.read.json(str(tmp_path / "out/full_metadata")).select("branch").distinct().collect()} == {"v3_delete"}
    assert main(["stages", source, str(tmp_path / "one"), "--branches", "v1_parameter"]) == 0
    assert {r.branch for r in spark.read.json(str(tmp_path / "one/full_metadata")).select("branch").distinct().collect()} == {"v1_parameter"}


def test_records_filter_audit_merge(spark, tmp_path):
    code = BLOCK + '.faces(">Z").workplane().hole(7)'
    chat = lambda said: [{"role": "system", "content": "Cut."}, {"role": "assistant", "content": said}]
    rows = [{"id": "a", "messages": chat(f"<code>{code}</code>"), "images": ["x/input_rect/1.png"]}, {"messages": chat("none"), "images": ["2.png"]}, "[1]"]
    source = lines(tmp_path / "records.jsonl", rows)
    assert main(["records", source, str(tmp_path / "found")]) == 0
    found = spark.read.json(str(tmp_path / "found/programs")).collect()
    assert [(r.id, r.code) for r in found] == [("a", code)]
    assert {x["status"]: x["n"] for x in json.loads((tmp_path / "found/summary.json").read_text())["status"]} == {"ok": 1, "no_code": 1, "not_an_object": 1}
    (tmp_path / "image/Rects").mkdir(parents=True)
    (tmp_path / "image/Rects/1.png").write_bytes(b"png")
    some = lines(tmp_path / "some.jsonl", rows[:2])
    assert main(["filter", some, str(tmp_path / "kept"), "--content", "Cut.", "--image-root", str(tmp_path / "image"), "--images", str(tmp_path), "--require-images"]) == 1
    assert [r.images for r in spark.read.json(str(tmp_path / "kept/records")).collect()] == [[f"{tmp_path}/image/Rects/1.png"]]
    assert main(["filter", some, str(tmp_path / "no"), "--content", "Other."]) == 1
    for chunk in ("c1", "c2"):
        assert main(["audit", lines(tmp_path / f"{chunk}.jsonl", [{"id": chunk, "code": code, "images": ["./image/Rects/1.png"]}]), str(tmp_path / "chunks" / chunk), "--chunk", chunk]) == 0
    audit = json.loads((tmp_path / "chunks/c1/summary.json").read_text())
    assert {(h["category"], h["label"]): h["n"] for h in audit["holes"]} == {("Rects", "hole_calls_total"): 1, ("Rects", "single_high_confidence_hole"): 1}
    assert main(["merge", str(tmp_path / "chunks"), str(tmp_path / "merged")]) == 0
    whole = json.loads((tmp_path / "merged/summary.json").read_text())
    assert (whole["chunks"], whole["missing"], whole["input_records"]) == (2, [], 2) and whole["top_rejection_reasons"] == []
    assert sorted(x["sample_id"] for x in whole["samples"] if x["edit_type"] == "delete_hole") == ["v3_delete_c1_0", "v3_delete_c2_0"]
    merged = {x["edit_type"]: x["candidates"] for x in json.loads((tmp_path / "merged/summary.json").read_text())["counts"]}
    assert merged["delete_hole"] == 2 and merged["parameter_box"] == 6


def test_verify(tmp_path, capsys, spark):
    good = {"sample_id": "s", "images": ["a"], "instruction": "Widen it", "target_code": "x = 1"}
    assert main(["verify", "training", lines(tmp_path / "good.jsonl", [good, "", good])]) == 0
    assert main(["verify", "training", lines(tmp_path / "bad.jsonl", [good, {**good, "hidden": {}}])]) == 1
    assert "line 2: training_extra_fields" in capsys.readouterr().out
    assert main(["verify", "training", lines(tmp_path / "none.jsonl", [])]) == 1


def test_run_writes_a_query(spark, tmp_path):
    assert main(["run", "branch_family_map", "/root/testdata/sf0.001", "--out", str(tmp_path / "q"), "--format", "json"]) == 0
    assert spark.read.json(str(tmp_path / "q")).count() == 200
