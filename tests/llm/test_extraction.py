from loomwright.llm import extraction as X


def page(body, nav="<nav><ul><li><a href='/a'>Home</a></li></ul></nav>"):
    return (
        f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p><b>';</script></head><body>{nav}"
        f"<div class='ad'>Buy now</div><article>{body}</article><aside>Side</aside><form>Mail <input></form>"
        f"<div id='comments'><p>First!</p></div><footer>&copy; host</footer></body></html>"
    )


def test_blocks_references_and_white_space():
    text = X.remaining_text(page("<h1>A &amp; B</h1><p>x\n  y&nbsp;z<p>caf&eacute; <b>bo</b>ld<br>next"), None)
    assert text == "A & B\nx y z\ncafé bold\nnext"


def test_truncated_and_odd_pages():
    whole = page("<p>one two three</p>")
    for n in range(len(whole)):
        X.remaining_text(whole[:n], None)
    assert X.remaining_text("<html><body><article><p>kept</p><p cla", None) == "kept"
    assert X.remaining_text(None, None) == "" == X.remaining_text("", None)
    assert X.remaining_text("plain words < only", None) == "plain words < only"
    assert X.remaining_text("<div><div>" * 500 + "deep", None) == "deep"


def test_page_without_an_article_takes_the_heaviest_container():
    html = "<body><div class='menu'>m</div><div class='x'><p>long text of many words here</p></div><div class='y'><a href='/'>link</a></div></body>"
    assert X.remaining_text(html, None) == "long text of many words here"


def test_template_words_go_and_vectors_match_brute_force(spark):
    pages = [(i, "http://h.example/p", page(f"<div class='zz'><p>Reader service desk</p></div><p>own{i} text{i * 7} w{i % 3}</p>")) for i in range(12)]
    pages += [(50, "http://one.example/", page("<p>alone</p>")), (51, None, page("<p>no host</p>")), (52, "http://h.example/q", None), (53, "x", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: (r.text, r.n_chars) for r in X.extracted(df).collect()}
    assert got == {
        **{i: (t := f"own{i} text{i * 7} w{i % 3}", len(t)) for i in range(12)},
        50: ("alone", 5), 51: ("no host", 7), 52: ("", 0), 53: ("", 0),
    }
    vectors = {r.tag: (r.pages, r.total) for r in X.occurrence_vectors(df).filter("host = 'h.example'").collect()}
    assert vectors["<"] == (12, 12) and vectors["<html\0body\0article\0div.zz"] == (12, 12) and len([t for t in vectors if t is None]) == 1


def test_salted_join_gives_the_same(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"http://h{i % 2}.example/", page(f"<p>t{i}</p>")) for i in range(6)], "page_id long, url string, html string")
    monkeypatch.setattr(X, "SMALL", 0)
    assert sorted((r.page_id, r.text) for r in X.extracted(df).collect()) == [(i, f"t{i}") for i in range(6)]


def test_empty_table(spark):
    assert X.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
