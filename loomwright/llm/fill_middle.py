"""Fill-in-the-middle transformation of texts by escaped marker injection, with DataFrame functions only.

A delimiter that can't stand in an escaped text is put after each unit (a word
with the white space before it) by one regular expression; counting delimiters
counts units, and ``substring_index`` cuts the marked text at two ranks.  Parts
lose delimiters and escapes and are assembled with the markers of their form.
Each row is worked on by itself: no shuffle, no Python, no state.

Edge cases: a null text is the empty one, and stays plain; a text that holds a
marker stays plain; a null doc_id is hashed as ``null``; white space at the end
is a unit of its own; repeated rows get the same cut, since it depends on doc_id
and text alone; an empty table gives an empty result; further columns are kept
by ``fill_in_middle`` where their names don't clash with its own, and ignored by
the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: A word with the white space before it, or white space at the end.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Neither is white space, so that escaping leaves units as they are.
DELIMITER, ESCAPE = "\x1f", "\x1b"


def escaped(text: Column) -> Column:
    """``text`` without ``DELIMITER``: both special characters become ``ESCAPE`` and a letter."""
    return F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "e")), F.lit(DELIMITER), F.lit(ESCAPE + "d"))


def unescaped(text: Column) -> Column:
    """The inverse of ``escaped``, after all delimiters are taken out."""
    plain = F.replace(text, F.lit(DELIMITER), F.lit(""))
    return F.replace(F.replace(plain, F.lit(ESCAPE + "d"), F.lit(DELIMITER)), F.lit(ESCAPE + "e"), F.lit(ESCAPE))


def draw(seed: int, doc_id: Column) -> list[Column]:
    """Four numbers below 2^32 of a document, from the SHA-256 of the seed and its id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """``docs`` (doc_id, text) with n, form, prefix, middle, suffix (null if plain) and output.

    ``percent`` of the documents are transformed, ``spm_percent`` of these to the
    form with the suffix first.  Cuts fall on units, at two places drawn from
    ``seed`` and doc_id.
    """
    own = ("n", "form", "prefix", "middle", "suffix", "output")
    rows = docs.select(*[c for c in docs.columns if c not in own and not c.startswith("__")])
    rows = rows.withColumn("__t", F.coalesce(F.col("text"), F.lit("")))
    rows = rows.withColumns(
        {"__marked": F.regexp_replace(escaped(F.col("__t")), UNIT, "$0" + DELIMITER)}
        | {f"__h{k}": h for k, h in enumerate(draw(seed, F.col("doc_id")), 1)}
    )
    rows = rows.withColumn("n", F.char_length("__marked").cast("long") - F.char_length(F.replace("__marked", F.lit(DELIMITER), F.lit(""))))
    one, two = F.col("__h1") % (F.col("n") + 1), F.col("__h2") % (F.col("n") + 1)
    held = [F.contains("__t", F.lit(m)) for m in (PREFIX, SUFFIX, MIDDLE)]
    stays = (F.col("__t") == "") | held[0] | held[1] | held[2] | (F.col("__h3") % 100 >= percent)
    rows = rows.withColumns(
        {
            "__a": F.least(one, two).cast("int"),
            "__b": F.greatest(one, two).cast("int"),
            "form": F.when(stays, "plain").when(F.col("__h4") % 100 < spm_percent, "spm").otherwise("psm"),
        }
    )
    # The marked text ends with a delimiter: its last k + 1 pieces are the last k units.
    cut = F.col("form") != "plain"
    d = F.lit(DELIMITER)
    ranked = lambda of, count: F.call_function("substring_index", of, d, count.cast("int"))
    rows = rows.withColumn("__after", F.when(cut, ranked(F.col("__marked"), F.col("__a") - F.col("n") - 1)))
    parts = {
        "prefix": ranked(F.col("__marked"), F.col("__a")),
        "middle": ranked(F.col("__after"), F.col("__b") - F.col("__a")),
        "suffix": ranked(F.col("__marked"), F.col("__b") - F.col("n") - 1),
    }
    rows = rows.withColumns({k: F.when(cut, unescaped(v)) for k, v in parts.items()})
    psm = F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")
    spm = F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")
    out = F.when(F.col("form") == "plain", F.col("__t")).when(F.col("form") == "psm", psm).otherwise(spm)
    return rows.withColumn("output", out).drop("__t", "__marked", "__after", "__a", "__b", *[f"__h{k}" for k in range(1, 5)])


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of; parts hold no markers, so the first of each is the one put in."""
    upto = lambda text, mark: F.call_function("substring_index", text, F.lit(mark), F.lit(1))
    after = lambda text, mark: F.substr(text, F.locate(mark, text) + F.lit(len(mark)))
    p, s = after(output, PREFIX), after(output, SUFFIX)
    psm = F.concat(upto(p, SUFFIX), after(output, MIDDLE), upto(s, MIDDLE))
    spm = F.concat(upto(p, MIDDLE), after(output, MIDDLE), upto(s, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cuts, forms and digests of all documents."""
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    made = made.withColumn("restored", restored(F.col("output"), F.col("form")))
    return made.select(
        "doc_id", "n", "form",
        F.char_length("prefix").cast("long").alias("prefix_chars"), F.char_length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


OP11_SQL = r"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents),
d AS (
  SELECT *, len(units) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM u),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50
              THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:n], '') AS suffix
  FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
