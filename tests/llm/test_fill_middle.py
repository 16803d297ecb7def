"""Fill-in-the-middle against a plain version: units, cuts, forms, escapes and edge cases."""

import hashlib
import re

import pytest

from loomwright.llm import fill_middle

SPACE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]"


def plain_version(doc_id, text):
    text = text or ""
    units = re.findall(f"{SPACE}*{WORD}+|{SPACE}+", text)
    h = hashlib.sha256(f"42:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", p, m, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", p, m, f"<P>{p}<S>{s}<M>{m}"


ODD = [
    None, "", " ", "\n\t \x0b\x0c\r", "one", " lead", "trail ", "a  b\n\nc", "\x1f", "\x1b", "\x1b\x1f d\x1bd \x1be\x1f\x1f x",
    "a\x1bd b\x1fe", "has <P> inside", "<S>", "x<M", "< P> a <", "<S <P <M a b", "ends with <S", "héllo wörld \U0001f600\U0001f600 ok",
    "nb sp em sp", "$0 \\1 $1", "same same", "same same",
]


def test_equals_plain_version(spark):
    rows = [(i, ODD[i % len(ODD)]) for i in range(12 * len(ODD))] + [(None, "null id a b"), (7, "again one two three"), (9_000_000_001, "word " * 40_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made = fill_middle.fill_in_middle(df)
    back = made.withColumn("restored", fill_middle.restored(made["output"], made["form"]))
    got = sorted((repr((r.doc_id, r.text)), (r.n, r.form, r.prefix, r.middle, r.output)) for r in back.collect())
    assert got == sorted((repr((i, t)), plain_version(i, t)) for i, t in rows)
    assert back.filter("not restored <=> coalesce(text, '')").count() == 0
    assert {r.form for r in made.select("form").distinct().collect()} == {"plain", "spm", "psm"}


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b", "x", 5, "y")], "doc_id long, text string, n string, __t long, lang string")
    got = fill_middle.fill_in_middle(df)
    assert got.columns == ["doc_id", "text", "lang", "n", "form", "prefix", "middle", "suffix", "output"] and got.first().n == 2
    assert fill_middle.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("name", ["Python", "Pandas", "Arrow", "Exchange"])
def test_plan_has_no_python_and_no_shuffle(spark, name):
    made = fill_middle.fill_in_middle(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    assert name not in made._jdf.queryExecution().executedPlan().toString()
