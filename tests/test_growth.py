"""Signs, cached shapes of programs, and plans that grow no faster than their input."""

import ast
import random

import duckdb
import pytest

from loomwright.functions.programs import is_program
from loomwright.operators import candidates, graph
from loomwright.plans import catalogue, edits, stages
from loomwright.plans.registry import dealt

SF = "/root/testdata/sf0.001"

SCHEMA = "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"


def test_numbers_that_round_to_nothing_keep_the_sign_of_the_sql(spark, tmp_path):
    taxes = (0.9999999, 0.99999, 0.9997, 0.99951, 0.9995, 0.99, 1.0, 1.00003, 1.00005, 1.0004)
    rows = [(n, 1, 3.0, 0.0, 0.0, t) for n, t in enumerate(taxes)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "lineitem.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    names = ["l_orderkey", "four", "two", "short", "written"]
    want = con.sql(f"SELECT {', '.join(names)} FROM ({catalogue.SQL['number_formats']})").fetchall()
    got = catalogue.QUERIES["number_formats"](spark, str(tmp_path)).select(*names).collect()
    # As text, so that -0.0 isn't 0.0.
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert {"-0", "0"} <= {r.short for r in got}


def plan_of(df, mode="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), mode)().toString()


@pytest.mark.parametrize("name", ["delete_spans_udtf", "delete_forms", "verify_delete_candidates", "hole_diagnostics", "add_candidates"])
def test_a_small_file_of_many_parts_is_dealt_over_all_cores(spark, name):
    plan = plan_of(catalogue.QUERIES[name](spark, SF))
    assert "RepartitionByExpression" in plan or "Repartition " in plan


def test_more_rows_give_more_tasks(spark):
    assert dealt(spark.range(90, numPartitions=1), 10).rdd.getNumPartitions() == 9
    assert dealt(spark.range(3, numPartitions=1), 10).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_nothing_is_joined_to_make_candidates(spark):
    pool = stages.pool(edits._with_faces(edits._programs(spark, SF)), deleted_box=edits._with_changed, facts=["p_size"])
    assert "Join" not in plan_of(pool)
    assert {r.branch for r in pool.select("branch").distinct().collect()} == set(stages.BRANCHES)


@pytest.mark.parametrize("name", ["policy_slot_replace", "policy_cutout_replace", "policy_cutout"])
def test_no_check_is_computed_under_a_lambda(spark, name):
    lines = [x for x in plan_of(catalogue.QUERIES[name](spark, SF)).split("\n") if "lambda" in x]
    assert lines and not any("l_quantity" in x or "* q" in x or "POWER" in x or "rint" in x.lower() for x in lines)


def test_programs_of_one_shape_are_parsed_once(monkeypatch):
    calls, parse = [], ast.parse
    monkeypatch.setattr(ast, "parse", lambda text: calls.append(text) or parse(text))
    code = 'result = cq.Workplane("XY").box(9{0}, 70, {0}.5).faces(">Z").workplane().hole({1}, depth={0})\n'
    for n in range(1, 60):
        text = code.format(n, n * 3)
        ((kind, size, _, _, depth, start, end, block, left),) = candidates.deletions_of(text)
        assert (kind, size, depth, block) == ("delete_hole", n * 3, n, text[start:end]) and left == text[:start] + text[end:]
    assert len(calls) <= 2


@pytest.mark.parametrize("number", ["7", "0", "7.5", "1e-5", "1E+5", "0x1F", "1_0", "00", "1j", "12345678901234567890", "5.", ".5", "-3", "(1)"])
def test_odd_numerals_are_read_as_they_stand(number):
    for before in ("", "# 3 \u00f8\n", "s = '\\1'\n", "x = 1e-7\n", "# a\r# b\n"):
        text = f"{before}result = cq.box({number}, 2, 3)\n"
        for _ in range(2):
            try:
                tree = ast.parse(text)
            except SyntaxError:
                assert candidates.parameters_of(text) == [] and not is_program(text)
                continue
            assert is_program(text)
            args = [float(a.value) for a in tree.body[-1].value.args if isinstance(a, ast.Constant) and isinstance(a.value, (int, float)) and a.value > 0]
            assert [x[3] for x in candidates.parameters_of(text)] == args


def test_components_of_stars_and_chains(spark):
    rng = random.Random(3)
    labels = rng.sample(range(10_000), 900)
    edges = list(zip(labels[:12], labels[1:13]))  # a chain in no order
    edges += [(max(labels) + 1, x) for x in labels[450:700]]  # the highest in the middle
    edges += [(x, x) for x in labels[700:710]] + [(labels[720], labels[721])] * 3
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, top(x)) for x in parent)
