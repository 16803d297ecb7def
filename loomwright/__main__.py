"""Command line: queries, stages, and the checks between stages.

    python -m loomwright list
    python -m loomwright run coverage_by_type TABLES --out FOLDER [--format json]
    python -m loomwright filter RECORDS.jsonl FOLDER --content TEXT [--image-root ./image] [--images FOLDER --require-images]
    python -m loomwright records RECORDS.jsonl FOLDER [--start 0] [--limit N]
    python -m loomwright stages PROGRAMS.jsonl FOLDER [--branches v1_parameter,v3_delete] [--seed 17] [--target 10000] [--answers ANSWERS.jsonl] [--report]
    python -m loomwright audit PROGRAMS.jsonl FOLDER
    python -m loomwright merge CHUNKS FOLDER [--elapsed most|sum]
    python -m loomwright verify KIND FILE.jsonl

verify, filter and stages end with 1 where something is wrong, or nothing is there.
A folder that has something in it is only written over where --overwrite-below names
a folder above it.  Counts come from the pass that writes; progress goes to stderr.
"""

from __future__ import annotations

import argparse
import json
import sys

#: Messages that are printed; all are counted.
SHOWN = 50


def told(stage: str, counters: dict, seconds: float) -> None:
    """A line of progress: what a stage counted, as JSON."""
    print(json.dumps({"stage": stage, "seconds": seconds, **counters}, default=str), file=sys.stderr)


def filter_records(spark, args) -> int:
    """Records with a message of the given text, their image paths moved; 1 if there are none, or files lack where they must not."""
    from pyspark.sql import functions as F

    from .functions.records import moved_image
    from .operators import reports
    from .operators.counters import Counters
    from .sources import folders, images, jsonl

    counters = Counters("filter", matched_records=F.lit(True), records_with_missing_images=F.col("lacks"), output_records=F.col("kept"))
    rows = jsonl.read_numbered(spark, args.records).withColumn("record", F.parse_json("raw"))
    said = F.try_variant_get("record", "$.messages", "array<struct<content: string>>")
    rows = rows.filter(F.exists(said, lambda m: m["content"] == args.content))
    paths = F.transform(F.try_variant_get("record", "$.images", "array<string>"), lambda p: moved_image(p, args.image_root))
    rows = rows.select("source_line", "raw", paths.alias("images")).withColumn("lacks", F.lit(False))
    if args.images:
        missing = images.missing(rows, "images", "source_line", images.listing(spark, args.images), args.images)
        lacking = missing.select("source_line", F.lit(True).alias("gone")).distinct()
        rows = rows.drop("lacks").join(lacking, "source_line", "left").withColumn("lacks", F.coalesce("gone", F.lit(False))).drop("gone")
    rows = counters.over(rows.withColumn("kept", ~F.col("lacks") if args.require_images else F.lit(True))).filter("kept")
    out = rows.select("source_line", "images", F.to_json(F.parse_json("raw")).alias("record"))
    folders.committed(spark, f"{args.out}/records", lambda new: out.write.json(new))
    counts = {k: v for k, v in counters.read().items() if k != "rows"}
    told("filter", counts, counters.elapsed)
    reports.write_text(spark, f"{args.out}/summary.json", reports.summary_json(counts))
    return int(counts["matched_records"] == 0 or (args.require_images and counts["records_with_missing_images"] > 0))


def extract_records(spark, args) -> int:
    """Programs of chat records, for ``stages``; a summary counts what came of each record."""
    from pyspark.sql import functions as F

    from .functions.records import STATUSES, read_records
    from .operators import reports
    from .operators.counters import Counters
    from .sources import folders, jsonl

    counters = Counters("records", {s: F.count_if(F.col("status") == s) for s in STATUSES})
    found = counters.over(read_records(jsonl.row_range(jsonl.read_numbered(spark, args.records), args.start, args.limit)))
    programs = found.filter("status = 'ok'").select(F.col("source_id").alias("id"), F.col("original_code").alias("code"), "images")
    folders.committed(spark, f"{args.out}/programs", lambda new: programs.write.json(new))
    counts = counters.read()
    told("records", counts, counters.elapsed)
    status = [{"status": s, "n": counts[s]} for s in STATUSES if counts[s]]
    reports.write_text(spark, f"{args.out}/summary.json", reports.summary_json({"records": counts["rows"], "status": status}))
    return 0


def stages(spark, args) -> int:
    """Programs (id, code) to the pool, the selected records and the three exports, by split; 1 if instructions leak."""
    from pyspark.sql import functions as F

    from .functions import instructions as I
    from .operators import reports, stats
    from .operators.counters import Counters
    from .plans import stages as plans
    from .sources import folders, jsonl

    programs = jsonl.read_strict(spark, args.programs, "id string, code string, images array<string>")
    answers = jsonl.read_lenient(spark, args.answers, "sample_id string, answer string") if args.answers else None
    made = plans.pool(programs, plans.enabled(args.branches) if args.branches else None)
    seen = Counters("pool", plans.pool_counters())
    folders.fan_out(seen.over(made), f"{args.out}/pool", folders.branch_targets({b: b for b in plans.BRANCHES}, "all_validated_intermediate"))
    counts = plans.counted(seen.read())
    told("pool", {f"{b}/{k}": n for b, k, n, _ in counts}, seen.elapsed)

    pool = spark.read.schema(made.schema).json(f"{args.out}/pool/all_validated_intermediate")
    picked = plans.cap(plans.select(pool, args.seed), args.target, args.seed)
    given = plans.instruct(plans.with_meta(picked, "selected", args.version, args.seed), answers)
    shown = Counters("records", leaks=I.shows_code(F.col("instruction"), I.FINAL_CODE_WORDS), fallbacks=F.col("fallback_used"))
    written = shown.over(given)
    folders.fan_out(written, f"{args.out}/records", folders.branch_targets({}, "selected_all", ["train", "val", "test"]))
    records = spark.read.schema(given.schema).json(f"{args.out}/records/selected_all")
    exports = plans.exports(records)
    for name, rows in exports.items():
        folders.committed(spark, f"{args.out}/{name}", lambda new, rows=rows: jsonl.write_by(rows, new, "split"))
    had = shown.read()
    told("records", had, shown.elapsed)

    table = stats.coverage_of(spark.createDataFrame(counts, "branch string, edit_type string, candidates long, validated long"), ["branch", "edit_type"])
    if args.report:
        print(reports.markdown(table, ["branch", "edit_type", "candidates", "validated", "pass_rate"], [F.col("level"), F.col("branch"), F.col("edit_type")]))
    summary = {"coverage": table.orderBy("level", "branch", "edit_type"), "records": had["rows"], "fallbacks": had["fallbacks"], "leaks": had["leaks"]}
    reports.write_text(spark, f"{args.out}/summary.json", reports.summary_json(summary))
    if had["leaks"]:
        for row in plans.leaks(exports["training"]).limit(SHOWN).collect():
            print(f"{row['sample_id']}: {row['message']}", file=sys.stderr)
    return int(had["leaks"] > 0)


def audit(spark, args) -> int:
    """A summary that merges with those of other chunks, and what keeps holes from being deleted."""
    from pyspark.sql import functions as F

    from .functions.scalars import stable_score
    from .operators import candidates, contracts, reports, summaries
    from .operators.counters import Counters
    from .plans import stages as plans
    from .sources import folders, jsonl

    counters = Counters("audit")
    programs = jsonl.read_strict(spark, args.programs, "id string, code string, images array<string>")
    named = programs.withColumn("category", plans.category(F.col("images")))
    made = contracts.with_parsed(plans.pool(programs), "target_code", "parses")
    why = F.when(~F.col("ok"), F.when(F.col("parses"), "validation:the program sets no result").otherwise("validation:the program does not parse"))
    edits = made.join(named.select(F.col("id").alias("source"), "category"), "source", "left").select(
        F.lit(args.chunk).alias("chunk"), "branch", "category", "edit_type", "sample_id", "ok", why.alias("reason"), stable_score(F.lit(args.seed), F.col("sample_id")).alias("score")
    )
    folders.committed(spark, f"{args.out}/edits", lambda new: counters.over(edits).write.parquet(new))
    stored = spark.read.schema(edits.schema).parquet(f"{args.out}/edits")
    runs = named.agg(F.count(F.lit(1)).alias("records")).select(F.lit(args.chunk).alias("chunk"), "records", F.lit(counters.elapsed).alias("elapsed"))
    summary = summaries.summarised(stored, runs)
    folders.committed(spark, f"{args.out}/summary", lambda new: summary.write.json(new))
    holes = candidates.hole_diagnostics(named, "category").orderBy("category", "label")
    rates = summaries.rates(summary).orderBy("level", "branch", "key")
    reports.write_text(spark, f"{args.out}/summary.json", reports.summary_json({"rates": rates, "holes": holes, "reasons": summaries.top_reasons(stored, summary).orderBy("branch", F.desc("n"), "reason")}))
    told("audit", counters.read(), counters.elapsed)
    return 0


def merge(spark, args) -> int:
    """Chunks' summaries as one; 1 if a chunk has none."""
    from pyspark.sql import functions as F

    from .operators import reports, stats, summaries
    from .sources import folders, jsonl

    files, lacking = jsonl.chunks(spark, args.chunks, "summary.json")
    whole = summaries.merged(spark.read.schema(summaries.SUMMARY).json(f"{args.chunks}/*/summary"))
    edits = spark.read.schema(summaries.EDITS).parquet(f"{args.chunks}/*/edits")
    counts = whole.select(F.inline("counts")).groupBy("branch", "edit_type").agg(F.sum("candidates").alias("candidates"), F.sum("validated").alias("validated"))
    counts = counts.withColumn("pass_rate", stats.percent(F.col("validated"), F.col("candidates"))).orderBy("branch", "edit_type")
    folders.committed(spark, f"{args.out}/summary", lambda new: whole.write.json(new))
    missing = [r["chunk"] for r in lacking.orderBy("chunk").collect()]
    had = whole.first()
    report = {
        "chunks": files.select("chunk").distinct().count(), "missing": missing, "input_records": had["records"],
        "elapsed_seconds": had["elapsed_sum"] if args.elapsed == "sum" else had["elapsed_most"], "counts": counts,
        "rates": summaries.rates(whole).orderBy("level", "branch", "key"), "structural_add_delete_replace_ratio": summaries.structural_ratio(whole),
        "top_rejection_reasons": summaries.top_reasons(edits, whole).orderBy("branch", F.desc("n"), "reason"),
        "samples": whole.select(F.inline("samples")).select("edit_type", "sample_id"),
    }
    reports.write_text(spark, f"{args.out}/summary.json", reports.summary_json(report))
    return int(bool(missing))


def verify(spark, args) -> int:
    """Messages for lines that break a contract; 1 if there are any, or no lines."""
    from .operators import contracts
    from .sources import jsonl

    rows = jsonl.read_numbered(spark, args.file)
    found = contracts.verify(rows, args.kind).orderBy("source_line", "message")
    total, lines = found.count(), rows.count()
    for row in found.limit(SHOWN).collect():
        print(f"line {row['source_line']}: {row['message']}")
    print(f"{lines} lines, {total} messages")
    return int(total > 0 or lines == 0)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="loomwright", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list")
    run = commands.add_parser("run")
    run.add_argument("query")
    run.add_argument("tables")
    run.add_argument("--out", required=True)
    run.add_argument("--format", default="parquet", choices=("parquet", "json"))
    kept = commands.add_parser("filter")
    kept.add_argument("records")
    kept.add_argument("out")
    kept.add_argument("--content", required=True)
    kept.add_argument("--image-root", default="./image")
    kept.add_argument("--images")
    kept.add_argument("--require-images", action="store_true")
    read = commands.add_parser("records")
    read.add_argument("records")
    read.add_argument("out")
    read.add_argument("--start", type=int, default=0)
    read.add_argument("--limit", type=int)
    staged = commands.add_parser("stages")
    staged.add_argument("programs")
    staged.add_argument("out")
    staged.add_argument("--branches")
    staged.add_argument("--version", default="v1")
    staged.add_argument("--seed", type=int, default=17)
    staged.add_argument("--target", type=int, default=10_000)
    staged.add_argument("--answers")
    staged.add_argument("--report", action="store_true")
    audited = commands.add_parser("audit")
    audited.add_argument("programs")
    audited.add_argument("out")
    audited.add_argument("--chunk", default="whole")
    audited.add_argument("--seed", type=int, default=0)
    merged = commands.add_parser("merge")
    merged.add_argument("chunks")
    merged.add_argument("out")
    merged.add_argument("--elapsed", default="most", choices=("most", "sum"))
    checked = commands.add_parser("verify")
    checked.add_argument("kind")
    checked.add_argument("file")
    for command in (kept, read, staged, audited, merged):
        command.add_argument("--overwrite-below")
    args = parser.parse_args(argv)

    from .plans import catalogue

    if args.command == "list":
        print("\n".join(sorted(catalogue.QUERIES)))
        return 0
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("loomwright").getOrCreate()
    todo = {"filter": filter_records, "records": extract_records, "stages": stages, "audit": audit, "merge": merge, "verify": verify}
    if args.command in todo:
        if hasattr(args, "overwrite_below"):
            from .operators.reports import guarded
            from .sources.folders import Store

            if Store(spark, args.out).names(args.out):
                if args.overwrite_below is None:
                    print(f"{args.out} isn't empty; --overwrite-below lets it be written over", file=sys.stderr)
                    return 2
                guarded(args.out, args.overwrite_below)
        return todo[args.command](spark, args)
    catalogue.QUERIES[args.query](spark, args.tables).write.format(args.format).mode("errorifexists").save(args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
