"""Templates against a brute-force deduction, and what they decide."""

import random
from collections import defaultdict

import pytest

from loomwright.llm import extraction as X

SCHEMA = "page_id long, url string, html string"


def page(i):
    said = "".join(f"<section class='s{k}x'><p>Reader service desk {k}</p></section>" for k in range(3))
    return f"<html><body><nav>Home</nav><article>{said}<p>own{i} text{i * 7} w{i % 3}</p></article></body></html>"


def plain(i, rng):
    """A page without an article element; its classes say nothing, and some say the wrong thing."""
    words = lambda n, w: " ".join(f"{w}{rng.randrange(9000)}" for _ in range(n))
    links = "".join(f"<a href='/{k}'>{words(2, 'm')}</a> " for k in range(6))
    return (
        f"<html><body><div class='c1'>{links}</div><div class='c2'><div class='c3 comment search' id='x{i}'><h1>{words(4, 't')}</h1>"
        f"<p>{words(rng.randrange(3, 60), 'b')}</p><p>Write to the desk of readers</p><p>{words(5, 'e')}</p></div>"
        f"<div class='c4'><p>{words(8, 's')}</p></div></div><div class='c5'>All of it belongs to nobody</div></body></html>"
    )


def article(source):
    """What ``plain`` put into its article, read from its own marks."""
    inner = source.split("<h1>")[1].split("</div>")[0]
    return inner.replace("</h1><p>", "\n").replace("</p><p>", "\n").replace("</p>", "")


def test_text_is_the_same_however_pages_are_dealt(spark):
    rows = [(i, f"http://h{i % 3}.example/p", page(i)) for i in range(48)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = [(i, f"own{i} text{i * 7} w{i % 3}") for i, *_ in rows]
    for n in (1, 3, 12, 211):
        assert sorted((r.page_id, r.text) for r in X.extracted(df.repartition(n)).collect()) == want


def test_the_template_decides_on_pages_without_an_article(spark):
    rng = random.Random(4)
    rows = [(i, f"http://h{i % 2}.example/p", plain(i, rng)) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = {i: article(s).replace("Write to the desk of readers\n", "") for i, _, s in rows}
    for n in (1, 7):
        assert {r.page_id: r.text for r in X.extracted(df.repartition(n)).collect()} == want
    alone = {i: X.remaining_text(s, None) for i, _, s in rows}
    assert sum(alone[i] != want[i] for i in want) == len(rows)  # without the template each text is another


@pytest.mark.parametrize("seed", range(4))
def test_classes_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        parts = [f"<div class='k{'abc'[k]}'>" + "<p>same words here</p>" * rng.choice([1, 1, 2]) + f"<p>own {rng.randrange(5)}</p></div>" for k in range(3) if rng.random() < 0.8]
        rows.append((i, f"http://h{min(2, i % 4)}.example/", f"<body><div class=top>Top</div><main>{''.join(parts)}<p>x{i}</p></main></body>"))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.host: r.template for r in X.templates(df).collect()}
    for host in {X.host_of(u) for _, u, _ in rows}:
        pages = [X.Page(s) for _, u, s in rows if X.host_of(u) == host]
        vectors = defaultdict(lambda: [0] * len(pages))
        for n, p in enumerate(pages):
            for t in p.tags:
                vectors[t][n] += 1
            for path, text, _ in p.blocks:
                vectors[X.run_key(path, text)][n] += 1
        groups = defaultdict(set)
        for t, v in vectors.items():
            if 2 * sum(map(bool, v)) >= len(pages):
                groups[tuple(v)].add(t)
        valid = [g for g in groups.values() if any(isinstance(t, str) and t[0] == "<" and ">" + t[1:] in g for t in g)]
        found = X.json.loads(got[host])
        assert {frozenset(c["tags"]) for c in found["classes"]} == {frozenset(t for t in g if isinstance(t, str)) for g in valid}
        assert found["runs"] == sorted(t for g in valid for t in g if not isinstance(t, str)) and found["pages"] == len(pages)
        for i, c in enumerate(found["classes"]):
            assert -1 <= c["parent"] < len(found["classes"]) and c["parent"] != i
            if (outer := min(c["tags"], key=lambda t: (t.count("\0"), len(t)))) != "<" and "\0" in outer:
                around = "<" + outer[1:].rpartition("\0")[0]
                assert around in c["tags"] or around in found["classes"][c["parent"]]["tags"]


def test_a_page_that_is_all_template_keeps_its_text(spark):
    rows = [(i, "http://h.example/", "<body><article><p>the same each time</p></article><footer>end</footer></body>") for i in range(20)]
    clashing = spark.createDataFrame([(*r, "t", "s", 5, "host") for r in rows] + [(None, None, None, "t", "s", 5, "host")], SCHEMA + ", text string, slot string, pages int, host string")
    assert sorted((r.page_id or -1, r.text) for r in X.extracted(clashing).collect()) == [(-1, ""), *(((i or -1), "the same each time") for i in range(20))]


def test_a_very_long_page_and_repeated_rows(spark):
    long = "<body><main>" + "".join(f"<p>w{i}</p>" for i in range(60_000)) + "</main></body>"
    deep = "<div>" * 20_000 + "deep" + "</div>" * 20_000 + "<p>after</p>"
    got = X.extracted(spark.createDataFrame([(1, "http://a.b/", long)] * 2 + [(2, "http://c.d/", deep)], SCHEMA)).collect()
    assert sorted((r.page_id, r.n_chars) for r in got) == [(1, sum(len(f"w{i}") + 1 for i in range(60_000)) - 1)] * 2 + [(2, 10)]


def test_text_of_all_containers_without_an_article():
    words = lambda n, w: " ".join(f"{w}{i}" for i in range(n))
    html = f"<body><div class=post><p>{words(30, 'p')}</p><ul><li>{words(40, 'l')}</li></ul></div><div class=links><a href='/'>away</a></div></body>"
    assert X.remaining_text(html, None) == f"{words(30, 'p')}\n{words(40, 'l')}"
    html = f"<body><section id=a><p>{words(19, 'a')}</p></section><section id=b><p>{words(20, 'b')}</p></section></body>"
    assert X.remaining_text(html, None) == f"{words(19, 'a')}\n{words(20, 'b')}"


def test_attributes_by_their_whole_names():
    for mark in ("style='overflow:hidden'", 'aria-hidden="false"', "data-id=menu", 'class="!mt-0 post"', 'title="role=menu"'):
        assert X.remaining_text(f"<body class='no-sidebar'><article class='search-engines'><p>a</p><section {mark}><p>b</p></section></article></body>", None) == "a\nb", mark
    for mark in ("hidden", 'HIDDEN=""', "class=menu", "id = 'sidebar'"):
        assert X.remaining_text(f"<body><article><p>a c d</p><section {mark}><p>b</p></section></article></body>", None) == "a c d", mark


def test_scripts_are_not_closed_by_a_slash():
    assert X.remaining_text("<body><article><script src=x /><p>code</p></script><p>a</p></article></body>", None) == "a"
