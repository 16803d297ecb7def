"""Queries over the driver's tables, one or more for each operator, with their SQL.

The tables hold no programs, so operators run on columns of the same shape:
documents are samples (source: source, lang: branch, lang and length: edit type),
labels say what is valid, events are edits of users, line items are measured
facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import graph, joins, reports, rules, selection, stats, summaries, verify
from .registry import QUERIES, SQL, query, table

def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as samples, with labels."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("sample_id"), "source", F.col("lang").alias("branch"),
        F.concat_ws("_", "lang", (F.col("n_chars") % 4).cast("string")).alias("edit_type"), "n_chars", "text",
    )
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("sample_id"), "quality", "toxic")
    return docs.join(labels, "sample_id", "left")


SAMPLES = """
samples AS (SELECT d.doc_id AS sample_id, d.source, d.lang AS branch, d.lang || '_' || CAST(d.n_chars % 4 AS VARCHAR) AS edit_type,
            d.n_chars, d.text, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def score_sql(*parts: str) -> str:
    joined = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"(('0x' || substr(sha256({joined}), 1, 16))::UBIGINT::DOUBLE / 18446744073709551615.0)"


@query(f"""WITH {SAMPLES}
SELECT branch, edit_type, count(*) AS candidates, count(*) FILTER (quality = 1) AS validated,
  CAST(grouping(branch, edit_type) AS BIGINT) AS level, count(*) - count(*) FILTER (quality = 1) AS failed,
  printf('%.4f', count(*) FILTER (quality = 1) * 100.0 / count(*))::DOUBLE AS pass_rate
FROM samples GROUP BY GROUPING SETS ((branch, edit_type), (branch), (edit_type), ())""")
def coverage_by_type(spark, sf_dir):
    return stats.coverage(samples(spark, sf_dir), ["branch", "edit_type"], F.col("quality") == 1)


def _rules() -> rules.Rules:
    return [
        ("missing_label", F.col("quality").isNull()),
        ("validation_failed", F.col("quality") == 0),
        ("toxic", F.col("toxic") == 1),
        ("too_short", F.col("n_chars") < 200),
    ]


_REASONS = """list_filter([CASE WHEN quality IS NULL THEN 'missing_label' END, CASE WHEN quality = 0 THEN 'validation_failed' END,
  CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN n_chars < 200 THEN 'too_short' END], lambda x: x IS NOT NULL)"""


@query(f"""WITH {SAMPLES}
SELECT sample_id, CASE WHEN quality IS NULL THEN 'missing_label' WHEN quality = 0 THEN 'validation_failed'
  WHEN toxic = 1 THEN 'toxic' WHEN n_chars < 200 THEN 'too_short' END AS reason FROM samples""")
def gate_first_reason(spark, sf_dir):
    return samples(spark, sf_dir).select("sample_id", rules.first_reason(_rules()).alias("reason"))


@query(f"""WITH {SAMPLES}, r AS (SELECT unnest({_REASONS}) AS reason FROM samples)
SELECT reason, count(*) AS n FROM r GROUP BY reason""")
def gate_all_reasons(spark, sf_dir):
    return rules.reason_counts(samples(spark, sf_dir), rules.all_reasons(_rules()))


@query(f"""WITH {SAMPLES}, r AS (SELECT 'validation:' || text AS reason FROM samples WHERE quality = 0)
SELECT reason, count(*) AS n FROM r GROUP BY reason ORDER BY n DESC, reason LIMIT 30""")
def rejection_topk(spark, sf_dir):
    bad = samples(spark, sf_dir).filter("quality = 0")
    return stats.most_common(bad.select(F.concat(F.lit("validation:"), "text").alias("reason")), "reason", 30)


@query("""SELECT doc_id, CASE lang WHEN 'en' THEN 'parameter' WHEN 'de' THEN 'add' WHEN 'fr' THEN 'delete' ELSE 'replace' END AS family,
  CASE WHEN lang = 'en' THEN 'parameter' ELSE 'structural' END AS mode FROM documents""")
def branch_family_map(spark, sf_dir):
    family = F.create_map(*[F.lit(x) for x in ("en", "parameter", "de", "add", "fr", "delete")])
    named = F.coalesce(F.try_element_at(family, F.col("lang")), F.lit("replace"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", named.alias("family"), F.when(F.col("lang") == "en", "parameter").otherwise("structural").alias("mode")
    )


@query(r"""SELECT page_id, replace(url, '/', '\') AS raw, replace(replace(url, '/', '\'), '\', '/') AS image_key FROM pages""")
def image_key_normalize(spark, sf_dir):
    raw = F.replace("url", F.lit("/"), F.lit("\\"))
    return table(spark, sf_dir, "pages").select("page_id", raw.alias("raw"), F.replace(raw, F.lit("\\"), F.lit("/")).alias("image_key"))


@query("""WITH p AS (SELECT page_id, list_filter(string_split(url, '/'), lambda x: x <> '') AS s FROM pages)
SELECT page_id, CASE WHEN list_position(s, 'en') > 0 AND list_position(s, 'en') < len(s) THEN s[list_position(s, 'en') + 1]
  ELSE 'Unknown' END AS category FROM p""")
def category_segment(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", S.category_of(F.col("url"), "en").alias("category"))


@query("""SELECT page_id, CASE WHEN contains(url, '/en/') THEN 'English' WHEN contains(url, '/de/') THEN 'German'
  WHEN contains(url, '/fr/') THEN 'French' ELSE 'Unknown' END AS category FROM pages""")
def category_substring(spark, sf_dir):
    out = F
    for part, name in (("/en/", "English"), ("/de/", "German"), ("/fr/", "French")):
        out = out.when(F.contains("url", F.lit(part)), name)
    return table(spark, sf_dir, "pages").select("page_id", out.otherwise("Unknown").alias("category"))


def _chats(spark, sf_dir) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("messages")
    )
    return turns


@query("""SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id HAVING bool_or(role = 'assistant' AND length(text) > 200)""")
def message_exists_filter(spark, sf_dir):
    long = F.exists("messages", lambda m: (m["role"] == "assistant") & (F.length(m["text"]) > 200))
    return _chats(spark, sf_dir).filter(long).select("conv_id", F.size("messages").cast("long").alias("n"))


@query("""SELECT conv_id, arg_min(text, (turn, text)) AS answer FROM conversations WHERE role = 'assistant' GROUP BY conv_id""")
def first_assistant_message(spark, sf_dir):
    said = F.filter("messages", lambda m: m["role"] == "assistant")
    return _chats(spark, sf_dir).filter(F.size(said) > 0).select("conv_id", said[0]["text"].alias("answer"))


@query("""WITH c AS (SELECT conv_id, arg_min(text, (turn, text)) FILTER (role = 'user') AS u, arg_min(text, (turn, text)) FILTER (role = 'assistant') AS a
  FROM conversations GROUP BY conv_id)
SELECT conv_id, 'system' || chr(10) || 'user:' || u || chr(10) || 'assistant:<code>' || a || '</code>' AS chat FROM c WHERE u IS NOT NULL AND a IS NOT NULL""")
def chat_sft_build(spark, sf_dir):
    first = lambda role: F.try_element_at(F.filter("messages", lambda m: m["role"] == role), F.lit(1))["text"]
    rows = _chats(spark, sf_dir).select("conv_id", first("user").alias("u"), first("assistant").alias("a")).filter("u is not null and a is not null")
    messages = F.array(
        F.struct(F.lit("system").alias("role"), F.lit("system").alias("content")),
        F.struct(F.lit("user").alias("role"), F.concat(F.lit("user:"), "u").alias("content")),
        F.struct(F.lit("assistant").alias("role"), F.concat(F.lit("assistant:<code>"), "a", F.lit("</code>")).alias("content")),
    )
    return rows.select("conv_id", F.concat_ws("\n", F.transform(messages, lambda m: m["content"])).alias("chat"))


_BUILD = """b AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey {0}) AS n FROM orders)"""


def _built(spark, sf_dir, order: Column) -> DataFrame:
    build = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    probe = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return joins.lookup(probe, build, "c_custkey", [order]).select("c_custkey", "c_mktsegment", "o_orderkey", "matched")


@query(f"WITH {_BUILD.format('')} SELECT c_custkey, c_mktsegment, o_orderkey, o_orderkey IS NOT NULL AS matched FROM customer LEFT JOIN b ON c_custkey = o_custkey AND n = 1")
def join_first_wins(spark, sf_dir):
    return _built(spark, sf_dir, F.col("o_orderkey"))


@query(f"WITH {_BUILD.format('DESC')} SELECT c_custkey, c_mktsegment, o_orderkey, o_orderkey IS NOT NULL AS matched FROM customer LEFT JOIN b ON c_custkey = o_custkey AND n = 1")
def join_last_wins(spark, sf_dir):
    return _built(spark, sf_dir, F.desc("o_orderkey"))


@query("SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def semi_selected(spark, sf_dir):
    chosen = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(chosen, "doc_id", "left_semi")


@query("SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def anti_resume(spark, sf_dir):
    from ..streaming.resume import pending

    return pending(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), table(spark, sf_dir, "labels"), "doc_id")


@query("""SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS parts FROM orders
GROUP BY o_custkey HAVING count(DISTINCT o_orderpriority) > 1""")
def leakage_cross_split(spark, sf_dir):
    found = joins.crossing(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority")
    return found.select("o_custkey", F.array_join("parts", ",").alias("parts"))


@query("""SELECT count(*) AS total, count(*) FILTER (text = '') AS empty_text, count(*) FILTER (n_chars <> length(text)) AS bad_length,
  count(*) FILTER (lang IS NULL) AS no_lang, count(*) FILTER (source IS NULL) AS no_source,
  count(*) FILTER (text = '' OR n_chars <> length(text) OR lang IS NULL OR source IS NULL) = 0 AS ok FROM documents""")
def quality_checks(spark, sf_dir):
    bad = {
        "empty_text": F.col("text") == "", "bad_length": F.col("n_chars") != F.length("text"),
        "no_lang": F.col("lang").isNull(), "no_source": F.col("source").isNull(),
    }
    any_bad = F.lit(False)
    for c in bad.values():
        any_bad = any_bad | c
    return table(spark, sf_dir, "documents").agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(c).alias(k) for k, c in bad.items()], (F.count_if(any_bad) == 0).alias("ok")
    )


@query("""WITH g AS (SELECT user_id, count(*) AS c FROM events GROUP BY user_id)
SELECT count(*) AS groups, printf('%.4f', avg(c))::DOUBLE AS mean, median(c) AS median, max(c) AS most FROM g""")
def edits_per_source_stats(spark, sf_dir):
    return stats.per_group_stats(table(spark, sf_dir, "events"), "user_id")


_SPREAD = "SELECT CAST(user_id % 50 AS BIGINT) AS bucket, {0} AS ratio FROM events GROUP BY 1"
_COUNTS = "count(*) FILTER (event_type = 'click'), count(*) FILTER (event_type = 'view'), count(*) FILTER (event_type = 'purchase')"
_A, _B, _C = _COUNTS.split("), ")
_A, _B = _A + ")", _B + ")"


@query(_SPREAD.format(f"CASE WHEN {_A} > 0 AND {_B} > 0 AND {_C} > 0 THEN greatest({_A}, {_B}, {_C})::DOUBLE / least({_A}, {_B}, {_C}) END"))
def structural_ratio_strict(spark, sf_dir):
    return _spread(spark, sf_dir, True)


@query(_SPREAD.format(f"greatest(nullif({_A}, 0), nullif({_B}, 0), nullif({_C}, 0))::DOUBLE / least(nullif({_A}, 0), nullif({_B}, 0), nullif({_C}, 0))"))
def structural_ratio_positive(spark, sf_dir):
    return _spread(spark, sf_dir, False)


def _spread(spark, sf_dir, strict):
    kinds = [F.count_if(F.col("event_type") == k).alias(k) for k in ("click", "view", "purchase")]
    counts = table(spark, sf_dir, "events").groupBy((F.col("user_id") % 50).alias("bucket")).agg(*kinds)
    return counts.select("bucket", stats.spread([F.col("click"), F.col("view"), F.col("purchase")], strict).alias("ratio"))


@query(f"WITH {SAMPLES} SELECT branch, count(*) AS n, avg(CASE WHEN quality IS NULL THEN 1.0 ELSE 0.0 END) AS fallback_rate FROM samples GROUP BY branch")
def fallback_rate_by_group(spark, sf_dir):
    missing = F.col("quality").isNull().cast("double")
    return samples(spark, sf_dir).groupBy("branch").agg(F.count(F.lit(1)).alias("n"), F.avg(missing).alias("fallback_rate"))


@query("""SELECT event_id, CAST((value > 0)::INT + (value > 50)::INT + (json_extract(props, '$.k') IS NOT NULL)::INT
  + CASE WHEN event_type = 'error' THEN 0 ELSE 5 END AS BIGINT) AS completeness FROM events""")
def completeness_score(spark, sf_dir):
    """True checks, present facts, and 5 if there are no errors."""
    checks = F.array(F.col("value") > 0, F.col("value") > 50)
    present = F.get_json_object("props", "$.k").isNotNull()
    score = F.size(F.filter(checks, lambda x: x)) + present.cast("int") + F.when(F.col("event_type") == "error", 0).otherwise(5)
    return table(spark, sf_dir, "events").select("event_id", score.cast("long").alias("completeness"))


@query("""SELECT event_id, CAST(CASE WHEN value > 10 THEN 10 ELSE 0 END + (value > 50)::INT + (json_extract(props, '$.k') IS NOT NULL)::INT
  - 2 * (CAST(json_extract(props, '$.k') AS INTEGER) % 3) AS BIGINT) AS score FROM events""")
def validation_score(spark, sf_dir):
    """10 if valid, true checks and present facts, less 2 for each error."""
    k = F.get_json_object("props", "$.k").cast("int")
    score = F.when(F.col("value") > 10, 10).otherwise(0) + (F.col("value") > 50).cast("int") + k.isNotNull().cast("int") - 2 * (k % 3)
    return table(spark, sf_dir, "events").select("event_id", score.cast("long").alias("score"))


@query(f"SELECT doc_id, {score_sql('42', 'doc_id', 'source')} AS score FROM documents")
def stable_score(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.stable_score(F.lit(42), F.col("doc_id"), F.col("source")).alias("score"))


@query(f"""WITH {SAMPLES},
a AS (SELECT *, row_number() OVER (PARTITION BY source, branch, edit_type ORDER BY n_chars DESC, {score_sql('7', 'sample_id')}, sample_id) AS i FROM samples),
b AS (SELECT *, row_number() OVER (PARTITION BY source, branch ORDER BY i, {score_sql('7', 'branch', 'edit_type')}, edit_type) AS n FROM a),
c AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n, CASE branch WHEN 'fr' THEN 0 WHEN 'es' THEN 1 WHEN 'de' THEN 2 ELSE 3 END) AS pick FROM b)
SELECT sample_id, source, branch, edit_type, pick FROM c WHERE pick <= 10""")
def diverse_topk_per_source(spark, sf_dir):
    order = F.when(F.col("branch") == "fr", 0).when(F.col("branch") == "es", 1).when(F.col("branch") == "de", 2).otherwise(3)
    picked = selection.diverse_top_k(
        samples(spark, sf_dir), "source", "branch", "edit_type", F.col("n_chars"), S.stable_score(F.lit(7), F.col("sample_id")),
        order, 10, S.stable_score(F.lit(7), F.col("branch"), F.col("edit_type")),
    )
    return picked.select("sample_id", "source", "branch", "edit_type", "pick")


@query(f"""WITH {SAMPLES},
t AS (SELECT source, 2 * least(count(*) FILTER (branch = 'fr'), count(*) FILTER (branch = 'es')) AS target FROM samples GROUP BY source),
a AS (SELECT *, row_number() OVER (PARTITION BY source, edit_type ORDER BY {score_sql('3', 'sample_id')}, sample_id) AS i,
      count(*) OVER (PARTITION BY source, edit_type) AS sz FROM samples WHERE branch = 'en'),
b AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY i, sz, {score_sql('3', 'edit_type')}, edit_type) AS r FROM a)
SELECT sample_id, b.source, edit_type FROM b JOIN t ON b.source = t.source WHERE r <= target""")
def balanced_downsample(spark, sf_dir):
    rows = samples(spark, sf_dir)
    limits = rows.groupBy("source").agg(
        (2 * F.least(F.count_if(F.col("branch") == "fr"), F.count_if(F.col("branch") == "es"))).alias("target")
    )
    kept = selection.balanced_downsample(
        rows.filter("branch = 'en'"), "source", "edit_type", limits, S.stable_score(F.lit(3), F.col("sample_id")), S.stable_score(F.lit(3), F.col("edit_type"))
    )
    return kept.select("sample_id", "source", "edit_type")


@query("""WITH c AS (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1),
a AS (SELECT *, 1000 * n / sum(n) OVER ()::DOUBLE AS raw FROM c), b AS (SELECT *, floor(raw) AS base FROM a),
r AS (SELECT *, row_number() OVER (ORDER BY raw - base DESC, n DESC, c_mktsegment DESC) AS k, sum(base) OVER () AS s FROM b)
SELECT c_mktsegment, n, CAST(base + CASE WHEN k <= 1000 - s THEN 1 ELSE 0 END AS BIGINT) AS quota FROM r""")
def largest_remainder_quota(spark, sf_dir):
    counts = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return selection.largest_remainder(counts, "c_mktsegment", F.lit(1000))


_FILL = """k AS (SELECT *, least({target}, sum(n) OVER ({part})) AS t, count(*) OVER ({part}) AS k, row_number() OVER ({part} ORDER BY n, {key}) - 1 AS i,
   coalesce(sum(n) OVER ({part} ORDER BY n, {key} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pre FROM {rows}),
f AS (SELECT *, bool_and(n * (k - i) <= t - pre) OVER ({part} ORDER BY n, {key} ROWS UNBOUNDED PRECEDING) AS is_full FROM k),
g AS (SELECT *, t - coalesce(sum(n) FILTER (is_full) OVER ({part}), 0) AS rest, count(*) FILTER (NOT is_full) OVER ({part}) AS m FROM f),
h AS (SELECT *, row_number() OVER (PARTITION BY is_full ORDER BY n DESC, {key} DESC) AS r FROM g),
q AS (SELECT *, CAST(CASE WHEN is_full THEN n ELSE rest // greatest(m, 1) + CASE WHEN r <= rest % greatest(m, 1) THEN 1 ELSE 0 END END AS BIGINT) AS quota FROM h)"""


@query(f"""WITH c AS (SELECT p_brand || '/' || p_size // 8 AS kind, count(*) AS n FROM part GROUP BY 1),
{_FILL.format(target=900, part='', key='kind', rows='c')} SELECT kind, n, quota FROM q""")
def waterfill_quota(spark, sf_dir):
    kind = F.concat_ws("/", "p_brand", F.floor(F.col("p_size") / 8).cast("string"))
    counts = table(spark, sf_dir, "part").groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return selection.water_fill(counts, "kind", F.lit(900))


@query(f"""WITH {SAMPLES}, st AS (SELECT edit_type, source, count(*) AS n FROM samples GROUP BY 1, 2),
c AS (SELECT edit_type, sum(n) AS n FROM st GROUP BY 1),
{_FILL.format(target=200, part='', key='edit_type', rows='c')},
ra AS (SELECT st.edit_type, st.source, st.n, q.quota AS tot, q.quota * st.n / sum(st.n) OVER (PARTITION BY st.edit_type)::DOUBLE AS raw FROM st JOIN q ON st.edit_type = q.edit_type),
rb AS (SELECT *, row_number() OVER (PARTITION BY edit_type ORDER BY raw - floor(raw) DESC, n DESC, source DESC) AS rk, sum(floor(raw)) OVER (PARTITION BY edit_type) AS sb FROM ra),
rq AS (SELECT edit_type, source, floor(raw) + CASE WHEN rk <= tot - sb THEN 1 ELSE 0 END AS quota FROM rb),
s AS (SELECT *, row_number() OVER (PARTITION BY edit_type, source ORDER BY {score_sql('5', 'sample_id')}, sample_id) AS r FROM samples)
SELECT sample_id, s.edit_type, s.source FROM s JOIN rq ON s.edit_type = rq.edit_type AND s.source = rq.source WHERE r <= quota""")
def stratified_cap(spark, sf_dir):
    kept = selection.stratified_cap(samples(spark, sf_dir), "edit_type", "source", 200, S.stable_score(F.lit(5), F.col("sample_id")))
    return kept.select("sample_id", "edit_type", "source")


@query("""WITH r AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY sha256(CAST(event_id AS VARCHAR)), event_id) AS k FROM events)
SELECT event_id, event_type FROM r WHERE k <= 20""")
def hash_sample_per_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return selection.sample_per_key(events, ["event_type"], 20, [F.sha2(F.col("event_id").cast("string"), 256), F.col("event_id")])


@query("""WITH r AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type, user_id % 7 ORDER BY event_id) = 1 AS is_first FROM events)
SELECT event_id, event_type, is_first FROM r ORDER BY is_first DESC, sha256(CAST(event_id AS VARCHAR)), event_id LIMIT 100""")
def one_per_stratum(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", (F.col("user_id") % 7).alias("stratum"))
    hashed = [F.sha2(F.col("event_id").cast("string"), 256), F.col("event_id")]
    return selection.one_per_stratum(events, ["event_type", "stratum"], 100, [F.col("event_id")], hashed).select("event_id", "event_type", "is_first")


@query(f"""WITH g AS (SELECT DISTINCT source FROM documents),
r AS (SELECT source, row_number() OVER (ORDER BY {score_sql('11', 'source')}, source) AS r, count(*) OVER () AS n FROM g),
s AS (SELECT source, CASE WHEN r <= round_even(n * 0.8, 0) THEN 'train'
  WHEN r <= round_even(n * 0.8, 0) + least(round_even(n * 0.1, 0), n - round_even(n * 0.8, 0)) THEN 'val' ELSE 'test' END AS split FROM r)
SELECT doc_id, d.source, split FROM documents d JOIN s ON d.source = s.source""")
def grouped_split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return selection.grouped_split(docs, "source", 11).select("doc_id", "source", "split")


@query()
def connected_components(spark, sf_dir):
    """Parts p and suppliers s (as -1 - s, as both count from 0) that any line items join, without SQL."""
    lines = table(spark, sf_dir, "lineitem").filter("l_partkey is not null and l_suppkey is not null")
    return graph.components(lines.select(F.col("l_partkey").alias("a"), (-1 - F.col("l_suppkey")).alias("b")))


@query(r"""SELECT doc_id, CASE WHEN length(b) > 0 THEN trim(b) END AS code FROM (
  SELECT doc_id, regexp_extract('See:' || chr(10) || '```python' || chr(10) || text || '```' || chr(10) || 'end', '```[A-Za-z]*\n(.*?)```', 1, 's') AS b FROM documents)""")
def code_block_extract(spark, sf_dir):
    text = F.concat(F.lit("See:\n```python\n"), "text", F.lit("```\nend"))
    return table(spark, sf_dir, "documents").select("doc_id", S.fenced_code(text).alias("code"))


@query(r"""SELECT page_id, trim(regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'si')) AS title FROM pages""")
def tag_extract(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", S.tagged(F.col("html"), "title").alias("title"))


@query(r"""SELECT doc_id, regexp_matches(lower(text), '\b(add|the|remove)\b') OR contains(lower(text), '%%%') AS found FROM documents""")
def token_match_word_boundary(spark, sf_dir):
    found = S.contains_any(F.col("text"), ["add", "the", "remove", "%%%"])
    return table(spark, sf_dir, "documents").select("doc_id", found.alias("found"))


@query(r"""SELECT doc_id, regexp_matches(text, '[\x{4e00}-\x{9fff}]') AS cjk FROM documents""")
def cjk_flag(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.has_cjk(F.col("text")).alias("cjk"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract_outermost(spark, sf_dir):
    wrapped = F.concat(F.lit("Here: ```json\n"), "props", F.lit("\n``` done"))
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object(S.outermost_json(wrapped), "$.k").cast("long").alias("k"))


_V = "CAST(embedding[{0}] AS DOUBLE)"
_BOX = ", ".join(f"{_V.format(i + 1)} - (abs({_V.format(i + 4)}) + 0.5) / 2 AS {a}min, {_V.format(i + 1)} + (abs({_V.format(i + 4)}) + 0.5) / 2 AS {a}max" for i, a in enumerate("xyz"))


@query(f"""WITH b AS (SELECT vec_id, {_BOX} FROM embeddings)
SELECT vec_id, round((xmax - xmin) * (ymax - ymin) * (zmax - zmin), 6) AS volume,
  xmin >= -1 AND xmax <= 1 AND ymin >= -1 AND ymax <= 1 AND zmin >= -1 AND zmax <= 1 AS inside FROM b""")
def bbox_algebra(spark, sf_dir):
    v = [F.col("embedding")[i].cast("double") for i in range(6)]
    b = S.box(v[:3], [F.abs(x) + 0.5 for x in v[3:]])
    unit = S.box([F.lit(0.0)] * 3, [F.lit(2.0)] * 3)
    x, y, z = S.box_dims(b)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(x * y * z, 6).alias("volume"), S.box_within(b, unit).alias("inside"))


@query("SELECT p_partkey, round(p_size * cos(pi() / (3 + p_partkey % 6)), 6) AS radius FROM part")
def polygon_to_circle(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.round(S.inscribed_radius(F.col("p_size"), 3 + F.col("p_partkey") % 6), 6).alias("radius"))


@query("""SELECT doc_id, substr(text, 1, 3) || '<' || CAST(doc_id AS VARCHAR) || '>' || substr(text, 8) AS text FROM documents""")
def span_splice(spark, sf_dir):
    new = F.concat(F.lit("<"), F.col("doc_id").cast("string"), F.lit(">"))
    return table(spark, sf_dir, "documents").select("doc_id", S.splice(F.col("text"), F.lit(3), F.lit(7), new).alias("text"))


@query("""WITH c AS (SELECT l_suppkey % 8 AS chunk, l_returnflag, count(*) AS candidates, count(*) FILTER (l_quantity > 25) AS validated, max(l_extendedprice) AS elapsed FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, CAST(sum(candidates) AS BIGINT) AS candidates, CAST(sum(validated) AS BIGINT) AS validated, max(elapsed) AS elapsed, printf('%.4f', sum(validated) * 100.0 / sum(candidates))::DOUBLE AS pass_rate FROM c GROUP BY 1""")
def chunk_merge_agg(spark, sf_dir):
    chunks = table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 8).alias("chunk"), "l_returnflag").agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("l_quantity") > 25).alias("validated"), F.max("l_extendedprice").alias("elapsed")
    )
    return stats.merged(chunks, ["l_returnflag"])


_AUDITED = f"""e AS (SELECT substr(md5(CAST(d.doc_id AS VARCHAR)), 1, 1) AS chunk, CASE d.lang WHEN 'en' THEN 'v2_add' WHEN 'de' THEN 'v3_delete' WHEN 'fr' THEN 'v4_replace' ELSE 'v1_parameter' END AS branch,
  d.source AS category, d.lang || '_' || CAST(length(d.text) % 4 AS VARCHAR) AS edit_type, CAST(d.doc_id AS VARCHAR) AS sample_id, coalesce(l.quality = 1, false) AS ok,
  'validation:' || substr(d.text, 1, 2) AS reason, {score_sql('5', 'd.doc_id')} AS score, d.n_chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def _audited(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Documents as audited edits in chunks by a hash of their numbers, and the chunks' runs."""
    branch = F.when(F.col("lang") == "en", "v2_add").when(F.col("lang") == "de", "v3_delete").when(F.col("lang") == "fr", "v4_replace").otherwise("v1_parameter")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = table(spark, sf_dir, "documents").join(labels, "doc_id", "left").select(
        F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1).alias("chunk"), branch.alias("branch"), F.col("source").alias("category"),
        F.concat_ws("_", "lang", (F.char_length("text") % 4).cast("string")).alias("edit_type"), F.col("doc_id").cast("string").alias("sample_id"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("ok"), F.concat(F.lit("validation:"), F.substring("text", 1, 2)).alias("reason"),
        S.stable_score(F.lit(5), F.col("doc_id")).alias("score"), "n_chars",
    )
    runs = rows.groupBy("chunk").agg(F.count(F.lit(1)).alias("records"), F.max("n_chars").alias("elapsed"))
    return rows.drop("n_chars"), runs


def _merged_audit(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The edits, and the summary of all chunks by way of two halves; few reasons are kept, so that bounds matter."""
    edits, runs = _audited(spark, sf_dir)
    chunks = summaries.summarised(edits, runs, most=15)
    halves = [summaries.merged(chunks.filter(half), most=15) for half in (F.col("chunk") < "8", F.col("chunk") >= "8")]
    return edits, summaries.merged(halves[0].unionByName(halves[1]), most=15)


@query(f"""WITH {_AUDITED}, r AS (SELECT 'branch' AS level, branch, branch AS key, ok FROM e UNION ALL SELECT 'edit_type', branch, edit_type, ok FROM e UNION ALL SELECT 'category', branch, category, ok FROM e)
SELECT level, branch, key, count(*) AS candidates, count(*) FILTER (ok) AS validated, count(*) FILTER (NOT ok) AS failed, printf('%.4f', count(*) FILTER (ok) * 100.0 / count(*))::DOUBLE AS pass_rate FROM r GROUP BY ALL""")
def merged_audit_rates(spark, sf_dir):
    """Rates by branch, edit type and category from the chunks' merged summaries."""
    return summaries.rates(_merged_audit(spark, sf_dir)[1])


@query(f"""WITH {_AUDITED}, c AS (SELECT chunk, count(*) AS records, max(n_chars)::DOUBLE AS elapsed FROM e GROUP BY 1),
v AS (SELECT count(*) FILTER (ok AND branch = 'v2_add') AS v2_add, count(*) FILTER (ok AND branch = 'v3_delete') AS v3_delete, count(*) FILTER (ok AND branch = 'v4_replace') AS v4_replace FROM e),
q AS (SELECT *, printf('%.4f', greatest(nullif(v2_add, 0), nullif(v3_delete, 0), nullif(v4_replace, 0))::DOUBLE / least(nullif(v2_add, 0), nullif(v3_delete, 0), nullif(v4_replace, 0)))::DOUBLE AS ratio FROM v)
SELECT (SELECT CAST(sum(records) AS BIGINT) FROM c) AS records, (SELECT max(elapsed) FROM c) AS elapsed_most, (SELECT sum(elapsed) FROM c) AS elapsed_sum, v2_add, v3_delete, v4_replace, ratio, coalesce(ratio <= 9, false) AS passes FROM q""")
def merged_audit_run(spark, sf_dir):
    """Records, the longest and the whole time of all chunks, and the ratio of structural branches."""
    merged = _merged_audit(spark, sf_dir)[1]
    return merged.select("records", "elapsed_most", "elapsed_sum").join(F.broadcast(summaries.structural_ratio(merged)))


@query(f"""WITH {_AUDITED}, c AS (SELECT branch, reason, count(*) AS n FROM e WHERE NOT ok GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY branch ORDER BY n DESC, reason) AS k FROM c)
SELECT branch, reason, n FROM r WHERE k <= 10""")
def merged_audit_reasons(spark, sf_dir):
    """The ten most frequent reasons of each branch, exactly, from summaries that keep fifteen."""
    return summaries.top_reasons(*_merged_audit(spark, sf_dir), k=10)


@query(f"""WITH {_AUDITED}, r AS (SELECT edit_type, sample_id, row_number() OVER (PARTITION BY edit_type ORDER BY score, sample_id) AS k FROM e WHERE ok) SELECT edit_type, sample_id FROM r WHERE k <= 5""")
def merged_audit_samples(spark, sf_dir):
    """Five samples of each edit type from the merged summaries: those of the whole run."""
    return _merged_audit(spark, sf_dir)[1].select(F.inline("samples")).select("edit_type", "sample_id")


@query(r"""WITH m AS (SELECT page_id, CASE WHEN url IS NULL THEN 'missing url' END AS a, CASE WHEN length(html) > 5000 THEN 'size above 5000' END AS b,
  CASE WHEN contains(lower(html), 'track(') THEN 'leaks track(' END AS c FROM pages)
SELECT page_id, unnest(list_filter([a, b, c], lambda x: x IS NOT NULL)) AS message FROM m""")
def verify_records(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumn("size", F.length("html"))
    checks = [*verify.required(["url"]), *verify.in_range("size", high=5000), *verify.no_leak(F.col("html"), ["track("])]
    return verify.violations(pages, "page_id", checks)


@query(f"""WITH b AS (SELECT vec_id, {_BOX} FROM embeddings)
SELECT vec_id, unnest(list_filter([CASE WHEN NOT xmin + 0.3 < xmax - 0.3 THEN 'bbox x not ordered' END, CASE WHEN NOT ymin + 0.3 < ymax - 0.3 THEN 'bbox y not ordered' END,
  CASE WHEN NOT zmin + 0.3 < zmax - 0.3 THEN 'bbox z not ordered' END], lambda x: x IS NOT NULL)) AS message FROM b""")
def verify_boxes(spark, sf_dir):
    v = [F.col("embedding")[i].cast("double") for i in range(6)]
    b = S.box_expanded(S.box(v[:3], [F.abs(x) + 0.5 for x in v[3:]]), -0.3)
    return verify.violations(table(spark, sf_dir, "embeddings"), "vec_id", verify.box_ordered(b, "bbox"))


@query("""SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, lang) AS INTEGER) AS position, '| ' || lang || ' | ' || CAST(count(*) AS VARCHAR) || ' |' AS line FROM documents GROUP BY lang""")
def markdown_report(spark, sf_dir):
    counts = table(spark, sf_dir, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return reports.markdown_rows(counts, ["lang", "n"], [F.desc("n"), F.col("lang")])


@query("""SELECT page_id, '<article><h2>' || replace(replace(replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') || '</h2><pre>'
  || replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') || '</pre></article>' AS card FROM pages""")
def html_cards(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", reports.card(F.col("url"), F.col("html")).alias("card"))


@query(r"""SELECT page_id, substr(regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g'), 1, 80) AS name, substr(sha256(CAST(page_id AS VARCHAR) || '|' || url), 1, 16) AS cache_key FROM pages""")
def safe_names_and_cache_keys(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", reports.safe_name(F.col("url")).alias("name"), reports.cache_key(F.col("page_id"), F.col("url")).alias("cache_key")
    )


@query("""WITH c AS (SELECT substr(sha256(lang || '|' || source), 1, 16) AS k, min(page_id) AS cached FROM pages JOIN documents ON page_id = doc_id GROUP BY 1)
SELECT doc_id, cached, cached IS NOT NULL AS hit FROM documents LEFT JOIN c ON substr(sha256(lang || '|' || source), 1, 16) = k""")
def cache_lookup(spark, sf_dir):
    """Answers by content key; here pages are the answers to the documents of their numbers."""
    docs = table(spark, sf_dir, "documents").select("doc_id", reports.cache_key(F.col("lang"), F.col("source")).alias("k"))
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("cached"))
    cached = docs.join(pages, F.col("doc_id") == F.col("cached")).select("k", "cached")
    return joins.lookup(docs, cached, "k", [F.col("cached")]).select("doc_id", "cached", F.col("matched").alias("hit"))


@query("""SELECT 'only_documents' AS side, count(*) AS n FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
UNION ALL SELECT 'both', count(*) FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)
UNION ALL SELECT 'any', count(*) FROM (SELECT doc_id FROM documents UNION SELECT doc_id FROM labels)""")
def set_operations(spark, sf_dir):
    a, b = (table(spark, sf_dir, t).select("doc_id") for t in ("documents", "labels"))
    sides = {"only_documents": a.subtract(b), "both": a.intersect(b), "any": a.union(b).distinct()}
    out = None
    for side, rows in sides.items():
        one = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(side).alias("side"), "n")
        out = one if out is None else out.union(one)
    return out


@query("""SELECT event_type, sum(CAST(value > 50 AS INT)) AS passed, count(*) AS n, bool_and(value >= 0) AS ready FROM events GROUP BY event_type""")
def readiness(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count_if(F.col("value") > 50).alias("passed"), F.count(F.lit(1)).alias("n"), F.bool_and(F.col("value") >= 0).alias("ready")
    )


from . import edits  # noqa: E402, F401 - registers the queries over programs, records and instructions
