"""Reports: tables as Markdown, cards as HTML, summaries as JSON."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def markdown_rows(df: DataFrame, columns: list[str], order: list[Column]) -> DataFrame:
    """``line`` with a Markdown row for each row; ``position`` in ``order``."""
    from pyspark.sql import Window

    cells = F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))
    return df.select(number.alias("position"), F.concat(F.lit("| "), cells, F.lit(" |")).alias("line"))


def markdown(df: DataFrame, columns: list[str], order: list[Column]) -> str:
    """The whole table as text; for reports, whose rows are few."""
    head = "| " + " | ".join(columns) + " |\n|" + "-|" * len(columns)
    lines = [r["line"] for r in markdown_rows(df, columns, order).orderBy("position").collect()]
    return "\n".join([head, *lines]) + "\n"


def escaped(text: Column) -> Column:
    """Text for HTML."""
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def card(title: Column, body: Column) -> Column:
    return F.concat(F.lit("<article><h2>"), escaped(title), F.lit("</h2><pre>"), escaped(body), F.lit("</pre></article>"))


def safe_name(text: Column, longest: int = 80) -> Column:
    """A text as a file name."""
    return F.substring(F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "_"), 1, longest)


def cache_key(*parts: Column) -> Column:
    """16 hexadecimal digits for what a cached answer depends on."""
    return F.substring(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), 1, 16)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text as one file, in whatever store the path names."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def summary_json(summary: dict) -> str:
    """A run's summary as indented JSON; tables in it (of few rows) become lists of objects."""
    plain = {k: [r.asDict(recursive=True) for r in v.collect()] if isinstance(v, DataFrame) else v for k, v in summary.items()}
    return json.dumps(plain, ensure_ascii=False, indent=2, default=str)


def guarded(path: str, base: str) -> str:
    """``path`` if it lies below ``base``; what is to be overwritten must."""
    whole, root = (os.path.abspath(p) if "://" not in p else p.rstrip("/") for p in (path, base))
    if whole == root or not whole.startswith(root.rstrip("/") + "/"):
        raise ValueError(f"{path} isn't below {base}")
    return path


def gallery(cards: list[str], title: str) -> str:
    """A page of cards."""
    name = title.replace("&", "&amp;").replace("<", "&lt;")
    return f"<!DOCTYPE html><html><head><meta charset=\"utf-8\"><title>{name}</title></head><body><h1>{name}</h1>{''.join(cards)}</body></html>\n"


def edit_card(title: Column, images: Column, instruction: Column, before: Column, after: Column) -> Column:
    """A card of an edit: its images, instruction, and both programs."""
    shown = F.array_join(F.transform(images, lambda i: F.concat(F.lit('<img src="'), escaped(i), F.lit('" loading="lazy">'))), "")
    return F.concat(
        F.lit("<article><h2>"), escaped(title), F.lit("</h2>"), F.coalesce(shown, F.lit("")), F.lit("<p>"), escaped(instruction),
        F.lit("</p><pre>"), escaped(before), F.lit("</pre><pre>"), escaped(after), F.lit("</pre></article>"),
    )


def box_drawing(box: Column, size: int = 120) -> Column:
    """A box seen from the front, as SVG: its limits to scale, the longest side ``size`` long."""
    wide, high = box["xmax"] - box["xmin"], box["zmax"] - box["zmin"]
    scale = F.lit(float(size)) / F.greatest(wide, high)
    w, h = F.round(wide * scale, 2), F.round(high * scale, 2)
    return F.format_string(f'<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 {size} {size}"><rect x="0" y="0" width="%.2f" height="%.2f" fill="none" stroke="black"/></svg>', w, h)
