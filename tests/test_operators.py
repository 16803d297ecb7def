"""Golden cases and loops that the window forms replace."""

import json
import math
import random
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomwright.functions import instructions, numbers, records, scalars
from loomwright.operators import candidates, graph, joins, reports, rules, selection
from loomwright.sources import images, jsonl, providers
from loomwright.streaming import resume

QUIET = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_water_fill_published_case(spark):
    # Published counts.
    have = {"chamfer": 1122, "circle": 6402, "extrude": 15971, "fillet": 2171, "hole": 2845}
    rows = spark.createDataFrame(list(have.items()), "k string, n long")
    got = {r.k: r.quota for r in selection.water_fill(rows, "k", F.lit(10000)).collect()}
    assert got == {"chamfer": 1122, "circle": 2236, "extrude": 2236, "fillet": 2171, "hole": 2235}


def test_stable_score_known_value(spark):
    row = spark.range(1).select(scalars.stable_score(F.lit(42), F.lit("a")).alias("s")).first()
    assert row.s == 0.5704492525256616


@QUIET
@given(st.lists(st.integers(0, 50), min_size=1, max_size=8), st.integers(0, 200))
def test_water_fill_is_even(spark, sizes, target):
    rows = spark.createDataFrame([(f"k{i}", n) for i, n in enumerate(sizes)], "k string, n long")
    got = [(r.n, r.quota) for r in selection.water_fill(rows, "k", F.lit(target)).collect()]
    assert sum(q for _, q in got) == min(target, sum(sizes))
    level = max((q for _, q in got), default=0)
    assert all(q <= n and (q == n or q >= level - 1) for n, q in got)


@QUIET
@given(st.lists(st.integers(1, 60), min_size=1, max_size=8), st.integers(0, 100))
def test_largest_remainder(spark, sizes, total):
    rows = spark.createDataFrame([(f"k{i}", n) for i, n in enumerate(sizes)], "k string, n long")
    got = selection.largest_remainder(rows, "k", F.lit(total)).collect()
    assert sum(r.quota for r in got) == total
    assert all(abs(r.quota - total * r.n / sum(sizes)) < 1 for r in got)


def test_diverse_top_k_takes_turns(spark):
    rows = [(i, "s", "ab"[i % 2], f"{'ab'[i % 2]}{i % 4 // 2}", i) for i in range(40)]
    df = spark.createDataFrame(rows, "sample_id long, source string, branch string, kind string, score long")
    order = F.when(F.col("branch") == "b", 0).otherwise(1)
    out = selection.diverse_top_k(df, "source", "branch", "kind", F.col("score"), F.col("sample_id"), order, 8, F.col("kind"))
    picked = out.orderBy("pick").collect()
    assert [r.branch for r in picked] == list("babababa")
    assert Counter(r.kind for r in picked) == {"a0": 2, "a1": 2, "b0": 2, "b1": 2}


def test_grouped_split_keeps_groups_whole(spark):
    df = spark.createDataFrame([(i, f"g{i % 20}") for i in range(200)], "id long, g string")
    out = selection.grouped_split(df, "g", 1)
    assert out.count() == 200
    assert joins.crossing(out, "g", "split").isEmpty()
    groups = {r["split"]: r["count"] for r in out.select("g", "split").distinct().groupBy("split").count().collect()}
    assert groups == {"train": 16, "val": 2, "test": 2}


def test_components_of_a_chain_and_an_island(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100}


def test_lookup_first_and_last(spark):
    build = spark.createDataFrame([(1, 5), (1, 7), (2, 9)], "k long, v long")
    probe = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    first = {r.k: (r.v, r.matched) for r in joins.lookup(probe, build, "k", [F.col("v")]).collect()}
    last = {r.k: r.v for r in joins.lookup(probe, build, "k", [F.desc("v")]).collect()}
    assert first == {1: (5, True), 2: (9, True), 3: (None, False)} and last == {1: 7, 2: 9, 3: None}


def test_reasons(spark):
    df = spark.createDataFrame([(1,), (12,), (None,)], "x int")
    named = [("missing", F.col("x").isNull()), ("small", F.col("x") < 10), ("odd", F.col("x") % 2 == 1)]
    got = df.select(rules.first_reason(named).alias("a"), rules.all_reasons(named).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [("small", ["small", "odd"]), (None, []), ("missing", ["missing"])]


BLOCK = 'import cadquery as cq\nresult = cq.Workplane("XZ").box(41, 29, 13)'


def test_parameters_and_scaling(spark):
    code = "r = w.circle(17).extrude(é_1, 3)\nr = r.box(1, -2, True).cboreHole(5, 9, 2)"
    found = candidates.parameters_of(code)
    assert [x[:4] + x[6:] for x in found] == [("circle", "circle", 0, 17.0, "17"), ("box", "box", 0, 1.0, "1"), ("hole", "cboreHole", 0, 5.0, "5")]
    df = spark.createDataFrame([("p", "é = w.circle(88)"), ("q", "w.hole(0.001)")], "id string, code string")
    out = {r.id: (r.new, r.target_code) for r in candidates.scaled_programs(candidates.parameter_candidates(df)).collect()}
    assert out == {"p": (132.0, "é = w.circle(132)"), "q": (0.002, "w.hole(0.002)")}
    assert candidates.parameters_of("not (a program") == [] and candidates.parameters_of(None) == []


def test_deletions():
    hole = BLOCK + '.faces(">Y").workplane().hole(9)'
    assert [(x[0], x[1], x[7]) for x in candidates.deletions_of(hole)] == [("delete_hole", 9.0, '.faces(">Y").workplane().hole(9)')]
    assert candidates.deletions_of(hole)[0][8] == BLOCK
    placed = BLOCK + '.faces(">Y").workplane().pushPoints([(0, 0)]).hole(9)'
    assert candidates.deletions_of(placed) == []
    assert [x[:2] for x in candidates.deletions_of(BLOCK + '.edges("|Y").chamfer(2)')] == [("delete_chamfer", 2.0)]
    loop = BLOCK + '.faces(">Y").workplane()\nfor k in range(5):\n    result = result.rotate((0, 0, 0), (0, 1, 0), 72).hole(4)\n'
    assert [x[:4] for x in candidates.deletions_of(loop)] == [("delete_hole", 4.0, None, 5)]
    assert candidates.deletions_of(loop)[0][7] == loop[len(BLOCK) : -1] and candidates.deletions_of(loop)[0][8] == BLOCK + "\n"
    disc = 'b = w.circle(50).extrude(12)\nresult = b.cut(w.polygon(5, 18).extrude(12))'
    assert [x[:3] for x in candidates.deletions_of(disc)] == [("delete_polygonal_cutout", 18.0, 5)]
    assert candidates.hole_contexts(hole) == ["hole_calls_total", "single_high_confidence_hole"]
    assert candidates.hole_contexts(placed)[1] == "pushpoints_rarray_polararray" and candidates.hole_contexts(loop)[1] == "simple_loop_holes"
    assert candidates.hole_contexts("x = y.hole(d)")[1] == "non_numeric_diameter" and candidates.hole_contexts("x = y.hole(3)")[1] == "other_unsupported_hole_contexts"
    assert candidates.hole_contexts("x = (") == ["hole_parse_error_records"] and candidates.hole_contexts(None) == ["records_without_code"]


def test_numbers_and_text(spark):
    df = spark.createDataFrame([(1.5, "Add a hole"), (10.0, "address 汉"), (0.125, "```json\nKeep {\"k\": 1} it\n```"), (2.0, '{"a": [1')], "x double, t string")
    got = df.select(
        scalars.format_number(F.col("x")).alias("n"), scalars.contains_any(F.col("t"), ["add", "汉"]).alias("c"),
        scalars.has_cjk(F.col("t")).alias("j"), scalars.outermost_json(F.col("t")).alias("o"), scalars.number_variants(F.col("x")).alias("v"),
    ).collect()
    assert [r.n for r in got] == ["1.5", "10", "0.125", "2"] and [r.c for r in got] == [True, True, False, False]
    assert [r.j for r in got] == [False, True, False, False] and [r.o for r in got] == [None, None, '{"k": 1}', None]
    assert set(got[1].v) == {"10", "10.0"} and set(got[2].v) == {"0.125", "0.12", "0.1"}


@QUIET
@given(st.lists(st.one_of(st.floats(-1e9, 1e9), st.integers(-99999, 99999).map(lambda n: n / 1000), st.sampled_from([2.675, 0.00015, 2.5, 1.0005, -0.00004, 0.0, 1e-30, 5e13])), min_size=1, max_size=60))
def test_numbers_are_rounded_as_python_does(spark, values):
    x = F.col("x")
    df = spark.createDataFrame([(v,) for v in values], "x double").select(
        "x", numbers.round_exact(x, 4).alias("four"), numbers.round_exact(x, 0).alias("none"), numbers.fixed_text(x, 2).alias("fixed"),
        numbers.float_text(numbers.round_exact(x, 3)).alias("text"), numbers.float_text(x).alias("whole"),
    )
    for r in df.collect():
        assert (r.four, r.none, r.fixed) == (round(r.x, 4), round(r.x, 0), f"{r.x:.2f}" if abs(r.x) >= 0.005 or r.x >= 0 else r.fixed), r
        assert float(r.text) == round(r.x, 3) and float(r.whole) == r.x and r.text.strip("-") == repr(abs(round(r.x, 3))), r


def test_instruction_of_each_type_is_valid_and_says_its_numbers(spark):
    df = spark.createDataFrame([(t,) for t in [*instructions.SENTENCES, "parameter_circle"]], "t string")
    sizes = {n: F.lit(float(i + 2)) for i, n in enumerate(("diameter", "radius", "length", "width", "depth", "distance"))} | {"sides": F.lit(5), "count": F.lit(3)}
    edit = instructions.edit_of(F.lit("circle"), None, F.lit(4.0), F.lit(6.5), hints=sizes, parameters=sizes, old_feature=sizes, new_feature=sizes)
    rows = df.select("t", instructions.template(F.col("t"), edit).alias("i"), instructions.validation_reasons(instructions.template(F.col("t"), edit), F.col("t"), edit).alias("w")).collect()
    said = {r.t: r.i for r in rows}
    assert said["parameter_circle"] == "Change the circle radius from 4 to 6.5, keeping the rest of the part unchanged."
    assert said["delete_hole"] == "Remove the group of 3 circular holes with a diameter of 2 mm, keeping the rest of the part unchanged."
    # A plain polygon or circle replacement doesn't name the diameter that comes first.
    silent = {"replace_circular_cutout_with_polygonal_cutout", "replace_polygonal_cutout_with_circular_cutout", "delete_polygonal_cutout"}
    assert {r.t for r in rows if r.w} <= silent and all("missing key dimension" in x for r in rows for x in r.w)


def test_programs_in_records(spark, tmp_path):
    code = 'import cadquery as cq\nresult = cq.Workplane("XY").box(1, 2, 3)'
    raws = [
        {"hidden": {"original_code": f" {code}\r\n"}}, {"messages": [{"role": "user", "content": "x"}, {"from": "GPT", "value": f"```python\n{code}\n```"}], "views": "v.PNG"},
        {"conversations": [{"role": "assistant", "content": [{"text": f"<think>a</think><answer>So:\n{code}\n</answer>"}]}], "id": 7}, {"deep": {"list": ["p.jpg", {"note": f"see\n{code}\n```\nend"}, "p.jpg"]}},
        {"messages": "none"},
    ]
    (tmp_path / "r.jsonl").write_text("".join(json.dumps(r) + "\n" for r in raws) + "3\n")
    got = records.read_records(jsonl.read_numbered(spark, str(tmp_path / "r.jsonl"))).orderBy("source_line").collect()
    assert [r.status for r in got] == ["ok"] * 4 + ["no_code", "not_an_object"]
    assert [r.original_code for r in got[:4]] == [code] * 4
    assert [r.images for r in got[:4]] == [[], ["v.PNG"], [], ["p.jpg"]] and [r.source_id for r in got] == ["line_000001", "line_000002", "7", "line_000004", "line_000005", "line_000006"]


def test_lines_are_numbered_over_blocks(spark, tmp_path):
    rows = [json.dumps({"n": i, "pad": "x" * (i % 50)}) if i % 7 else "" for i in range(1, 4000)]
    (tmp_path / "big.jsonl").write_text("\n".join(rows) + "\n")
    (tmp_path / "small.jsonl").write_text('{"n": 1}\r\n{"n": 2}')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = jsonl.read_numbered(spark, str(tmp_path))
        assert found.select("file").distinct().count() == 2 and found.rdd.getNumPartitions() > 3
        assert all(json.loads(r.raw)["n"] == r.source_line for r in found.collect()) and found.count() == sum(map(bool, rows)) + 2
        assert [r.source_line for r in jsonl.row_range(found.filter("file like '%big%'"), 10, 3).collect()] == [10, 11, 12]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert jsonl.read_lenient(spark, str(tmp_path / "absent"), "n long").count() == 0


def test_answers_are_cached_and_retried(spark, tmp_path, monkeypatch):
    questions = spark.createDataFrame([(f"k{i}", json.dumps({"n": i})) for i in range(5)], "key string, question string")
    tries = tmp_path / "tries"

    def provider(question):
        with tries.open("a") as f:
            f.write(f"{question['n']}\n")
        if question["n"] == 3 or (question["n"] == 1 and tries.read_text().split().count("1") < 2):
            raise ValueError("busy")
        return f"answer {question['n']}"

    found = {r.key: r for r in providers.asked(questions, provider, retries=2).collect()}
    assert found["k1"].answer == "answer 1" and found["k1"].attempts == 2 and found["k3"].answer is None and "busy" in found["k3"].error
    cache = str(tmp_path / "cache")
    first = {r.key: (r.answer, r.cached) for r in providers.with_cache(questions, cache, provider, 0).collect()}
    assert first["k0"] == ("answer 0", False) and first["k3"] == (None, False)
    offline = {r.key: (r.answer, r.cached) for r in providers.with_cache(questions, cache, None).collect()}
    assert offline["k0"] == ("answer 0", True) and offline["k3"] == (None, False)
    monkeypatch.setenv("SECOND_KEY", "v")
    assert providers.first_secret(["FIRST_KEY", "SECOND_KEY"]) == ("v", "SECOND_KEY")


def test_images_and_reports(spark, tmp_path):
    (tmp_path / "im").mkdir()
    (tmp_path / "im/a.png").write_bytes(b"abc")
    urls = images.data_urls(spark, str(tmp_path / "im")).collect()
    assert [r.url for r in urls] == ["data:image/png;base64,YWJj"]
    rows = spark.createDataFrame([(1, ["im/a.png"]), (2, ["im/a.png", "im/b.png"]), (3, [])], "k int, images array<string>")
    files = images.listing(spark, str(tmp_path))
    assert [r.k for r in images.with_images(rows, "images", "k", files, str(tmp_path)).collect()] == [1]
    assert [(r.k, r.missing) for r in images.missing(rows, "images", "k", files, str(tmp_path)).collect()] == [(2, ["im/b.png"])]
    reports.write_text(spark, str(tmp_path / "s.json"), reports.summary_json({"n": 1, "rows": spark.range(2)}))
    assert json.loads((tmp_path / "s.json").read_text()) == {"n": 1, "rows": [{"id": 0}, {"id": 1}]}
    assert reports.guarded(str(tmp_path / "x"), str(tmp_path))
    for bad in (str(tmp_path), "/etc"):
        try:
            reports.guarded(bad, str(tmp_path))
            raise AssertionError(bad)
        except ValueError:
            pass


def test_jsonl_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\n[2]\n{"x": 3\n')
    numbered = jsonl.read_numbered(spark, str(tmp_path / "a.jsonl"))
    assert [r.source_line for r in numbered.orderBy("source_line").collect()] == [1, 3, 4]
    assert sorted(int(r["at"].rsplit(":")[-1]) for r in jsonl.bad_lines(numbered).collect()) == [3, 4]
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "branch string, x int")
    jsonl.write_by(rows, str(tmp_path / "out"), "branch")
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["branch=a", "branch=b"]
    assert json.loads(next((tmp_path / "out/branch=a").glob("*.json")).read_text()) == {"x": 1}


def test_resume_and_follow(spark, tmp_path):
    out = str(tmp_path / "done")
    assert resume.resume(spark.range(5), out, "id") == 5
    assert resume.resume(spark.range(8), out, "id") == 3
    inbox = tmp_path / "in"
    spark.range(4).write.parquet(str(inbox))
    spark.range(2, 6).write.mode("append").parquet(str(inbox))
    schema = spark.range(1).schema
    resume.follow(spark, str(inbox), schema, "id", str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination(60)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "s")).collect()) == [0, 1, 2, 3, 4, 5]
    resume.running_counts(spark, str(inbox), schema, "id", str(tmp_path / "n"), str(tmp_path / "d")).awaitTermination(60)
    assert {r.id: r.n for r in resume.counts_so_far(spark, str(tmp_path / "n"), schema, "id").collect()} == {0: 1, 1: 1, 2: 2, 3: 2, 4: 1, 5: 1}


def test_numbers_are_rounded_on_their_binary_value(spark):
    """Halves, numbers beside them, and large ones, against Python's own rounding and spelling."""
    rng = random.Random(8)
    values = [0.0, 5e-05, 0.0005, -5e-05, 0.5, 2.675, 1e14, 1.5e15, -1e-9, 1e-05, 123456789.0, 123456789012.345678, -9e13 - 0.015625, float("inf"), float("-inf")]
    for _ in range(3000):
        tick = rng.randrange(-(10**7), 10**7) / 1e5
        values += [tick, math.nextafter(tick, math.inf), (2 * rng.randrange(-(10**6), 10**6) + 1) / 2 ** rng.randrange(1, 20), rng.uniform(-1, 1) * 10 ** rng.randrange(-9, 14)]
    x = F.col("x")
    rows = spark.createDataFrame([(v,) for v in values], "x double").select(
        "x", numbers.round_exact(x, 4).alias("four"), numbers.fixed_text(x, 2).alias("two"), numbers.short_text(x, 3).alias("short"), numbers.float_text(x).alias("text")
    )
    for r in rows.collect():
        assert r.four == round(r.x, 4) and math.copysign(1, r.four) == (1 if r.four == 0 else math.copysign(1, r.x)), r
        assert r.text == repr(r.x), r
        if abs(r.x) < 1e14:
            short = f"{r.x:.3f}".rstrip("0").rstrip(".")
            assert r.two == f"{r.x:.2f}" and r.short == ("0" if short == "-0" else short), r
    assert numbers.round_exact(F.lit(None), 4) is not None and spark.range(1).select(numbers.short_text(F.lit(None).cast("double"), 2)).first()[0] is None
