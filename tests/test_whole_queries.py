"""Queries over whole tables and whole texts."""

import random

from loomwright.plans import catalogue


def test_components_of_all_line_items_match_union_find(spark, tmp_path):
    rng = random.Random(5)
    lines = [(k, rng.randrange(1, 90), rng.randrange(1, 60)) for k in range(1, 71)] + [(400, 200, 201), (7, 200, 202), (8, None, 202), (9, 203, None), (10, 0, 300), (11, 301, 0)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    parent: dict = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for _, part, supplier in lines:
        if part is not None and supplier is not None:
            a, b = sorted((top(part), top(-1 - supplier)))
            parent[b] = a
    got = {r.node: r.component for r in catalogue.QUERIES["connected_components"](spark, str(tmp_path)).collect()}
    assert got == {x: top(x) for x in parent}
    assert len(set(got.values())) > 2


def test_whole_texts_pass_through(spark, tmp_path):
    long = "x = 1\n" * 50 + "end"
    texts = [(1, long), (2, long[:-1]), (3, long), (4, "short"), (5, None)]
    spark.createDataFrame([(i, t, "s", "en", len(t or "")) for i, t in texts], "doc_id long, text string, source string, lang string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 0, 0) for i in range(1, 5)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "u", "<p>" + long)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    run = lambda name: catalogue.QUERIES[name](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.code for r in run("code_block_extract")} == dict(texts)
    assert [(r.reason, r.n) for r in run("rejection_topk")] == [(f"validation:{long}", 2), ("validation:short", 1), (f"validation:{long[:-1]}", 1)]
    assert run("html_cards")[0].card.endswith("&lt;p&gt;" + long + "</pre></article>")
