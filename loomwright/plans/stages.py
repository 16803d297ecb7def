"""The stages from programs to training rows, as plans.

pool: programs to candidate edits of up to four branches; select: gates, splits
and diverse picks; cap: quotas; instruct: a model's answer where it passes, else
the template; assemble: joins, gates and the three exports.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import instructions as I
from ..functions.records import category_name
from ..functions.scalars import stable_score
from ..operators import candidates, contracts, joins, placement, replacements, rules, selection, verify
from ..operators.graph import ready_to_checkpoint

# Branches, what they do, and the texts of chat rows.
BRANCHES = {"v1_parameter": "parameter", "v2_add": "add", "v3_delete": "delete", "v4_replace": "replace"}
SYSTEM_TEXT = "You are an AI assistant specialized in precise CAD editing with CadQuery."
USER_TEXT = (
    "<image><image><image> Given the original dimensioned three-view drawings and the edit instruction, generate the edited executable "
    "CadQuery code. Edit instruction: "
)
TRAINING_FIELDS = contracts.TRAINING_FIELDS
#: Keys of edits that a task sorts.
KEYS = 200_000

Measure = Callable[[DataFrame], DataFrame]


def enabled(names: str) -> list[str]:
    """Branches of a comma-separated list; unknown ones raise."""
    chosen = [n.strip() for n in names.split(",") if n.strip()]
    if unknown := sorted(set(chosen) - set(BRANCHES)):
        raise ValueError(f"unknown branches: {unknown}")
    return chosen


def edit_types() -> dict[str, list[str]]:
    """The types of edits that each branch makes."""
    return {
        "v1_parameter": [f"parameter_{call}" for call in candidates.SCALABLE],
        "v2_add": list(placement.KINDS),
        "v3_delete": ["delete_hole", "delete_circular_cutout", "delete_polygonal_cutout", *[f"delete_{name}" for name in candidates.FINISHING]],
        "v4_replace": [*replacements.DIRECT_TYPES.values(), *replacements.SLOT_TYPES.values(), replacements.LOOP_TYPE],
    }


def pool_counters() -> dict[str, Column]:
    """Counters of a pool: candidates and valid ones of each branch and type, as ``branch/type/candidates`` and ``branch/type/validated``."""
    out, known = {}, F.lit(False)
    for branch, kinds in edit_types().items():
        for kind in kinds:
            here = (F.col("branch") == branch) & (F.col("edit_type") == kind)
            known = known | here
            out[f"{branch}/{kind}/candidates"] = F.count_if(here)
            out[f"{branch}/{kind}/validated"] = F.count_if(here & F.coalesce("ok", F.lit(False)))
    return out | {"other": F.count_if(~F.coalesce(known, F.lit(False)))}


def counted(counters: dict[str, object]) -> list[tuple[str, str, int, int]]:
    """(branch, edit_type, candidates, validated) of the types that have candidates, from ``pool_counters``."""
    out = []
    for branch, kinds in edit_types().items():
        for kind in kinds:
            n = int(counters[f"{branch}/{kind}/candidates"])
            out += [(branch, kind, n, int(counters[f"{branch}/{kind}/validated"]))] if n else []
    return out


def _sizes(kind: Column) -> dict[str, Column]:
    """Dimensions of a deleted feature, by their names in instructions."""
    size = F.col("size")
    return {
        "diameter": F.when(kind == "delete_hole", size).when(kind == "delete_circular_cutout", size * 2),
        "radius": F.when(kind.isin("delete_circular_cutout", "delete_polygonal_cutout", "delete_fillet"), size),
        "distance": F.when(kind == "delete_chamfer", size), "sides": F.col("sides"), "count": F.when(F.col("repeats") > 1, F.col("repeats")),
    }


def _record(rows: DataFrame, branch: str, candidate: Column, kind: Column, edit: Column, before: Column | None = None) -> DataFrame:
    return rows.select(
        F.concat(F.lit(f"{branch}_"), candidate).alias("sample_id"), F.col("id").alias("source"), F.lit(branch).alias("branch"), kind.alias("edit_type"),
        F.col("code").alias("original_code"), (before if before is not None else F.lit(None).cast("string")).alias("intermediate_code"), "target_code", edit.alias("edit"),
    )


def pool(
    programs: DataFrame, branches: list[str] | None = None, caps: dict[str, int] | None = None, deleted_box: Measure | None = None,
    factor: float = 1.5, keep_failed: bool = True, facts: Sequence[str] = (),
) -> DataFrame:
    """Candidate edits of programs (id, code; box and faces for additions), with ``ok``: whether the new program parses and sets its result.

    ``caps``: most edits of a program by branch.  ``deleted_box`` adds ``changed``
    and ``part_dims`` to deletions, as slots need, from the columns of programs that
    ``facts`` names.  All goes along with its program, so nothing is joined.  Edits that aren't ok stay if
    ``keep_failed`` says so.
    """
    chosen, most = branches or list(BRANCHES), {"v1_parameter": 3, "v2_add": 4, "v3_delete": 6, "v4_replace": 10} | (caps or {})
    ordinal, made = F.col("ordinal").cast("string"), []
    if "v1_parameter" in chosen:
        scaled = candidates.scaled_programs(candidates.parameter_candidates(programs, cap=most["v1_parameter"]), factor)
        edit = I.edit_of(F.col("call"), F.col("kind"), F.col("old"), F.col("new"))
        made.append(_record(scaled, "v1_parameter", F.concat_ws("_", "id", ordinal), F.concat(F.lit("parameter_"), "call"), edit))
    if "v2_add" in chosen and {"box", "faces"} <= set(programs.columns):
        added = placement.add_candidates(programs, placement.KINDS[: most["v2_add"]], keep=["code"])
        hints = {n: F.col(f"hints.{n}") for n in ("diameter", "depth", "length", "width")}
        made.append(_record(added, "v2_add", F.col("candidate_id"), F.col("edit_type"), I.edit_of(hints=hints)))
    gone = candidates.deletion_candidates(programs, cap=most["v3_delete"], keep=facts)
    kind = F.col("edit_type")
    if "v3_delete" in chosen:
        made.append(_record(gone, "v3_delete", F.concat_ws("_", "id", ordinal), kind, I.edit_of(hints=_sizes(kind), parameters=_sizes(kind))))
    if "v4_replace" in chosen:
        was = ["code", "left", "old_feature"]
        gone = gone.withColumns({"left": F.col("target_code"), "old_feature": I.edit_of(old_feature=_sizes(kind))["old_feature"]})
        direct = replacements.direct_replacements(gone, was)
        radius = F.col("radius")
        own = {n: F.col(f"old_feature.{n}") for n in ("diameter", "radius", "sides", "count", "distance")}
        hints = {"radius": radius, "sides": F.col("sides"), "distance": F.when(F.col("edit_type").isin("replace_chamfer_with_fillet", "replace_fillet_with_chamfer"), radius)}
        edit = I.edit_of(hints=hints, old_feature=own, new_feature={"radius": radius, "distance": hints["distance"]})
        made.append(_record(direct, "v4_replace", F.concat_ws("_", "id", ordinal, F.lit("direct")), F.col("edit_type"), edit, F.col("left")))
        if deleted_box is not None:
            slots = replacements.slot_replacements(deleted_box(gone), was)
            hints = {"diameter": F.col("old_feature.diameter"), "length": F.col("length"), "width": F.col("width")}
            edit = I.edit_of(hints=hints, old_feature=own, new_feature={"length": F.col("length"), "width": F.col("width")})
            made.append(_record(slots, "v4_replace", F.col("candidate_id"), F.col("edit_type"), edit, F.col("left")))
    out = made[0]
    for more in made[1:]:
        out = out.unionByName(more)
    out = contracts.with_parsed(out, "target_code", "ok")
    out = out.withColumn("ok", F.col("ok") & F.col("target_code").rlike(r"(?m)^\s*result\s*=(?!=)"))
    return out if keep_failed else out.filter("ok")


def stored(edits: DataFrame) -> DataFrame:
    """A stage's edits kept in the checkpoint folder, as stages that read them more than once need."""
    ready_to_checkpoint(edits.sparkSession)
    return edits.checkpoint()


def gates() -> rules.Rules:
    return [
        *verify.required(["sample_id", "original_code", "target_code"]),
        ("unchanged", F.col("original_code") == F.col("target_code")),
        ("validation_failed", ~F.coalesce(F.col("ok"), F.lit(False))),
    ]


def select(edits: DataFrame, seed: int, most: int = 4, columns: Sequence[str] = ("*",), tasks: int | None = None) -> DataFrame:
    """Valid edits, split by source, at most ``most`` of each source, branches in turn; of these edits the ``columns``, in ``tasks`` by source."""
    valid = edits.filter(rules.first_reason(gates()).isNull()).select(*columns)
    valid = valid.repartition(tasks, "source") if tasks else valid
    split = selection.grouped_split(valid, "source", seed)
    order = F.when(F.col("branch") == "v3_delete", 0).when(F.col("branch") == "v4_replace", 1).when(F.col("branch") == "v2_add", 2).otherwise(3)
    tie = stable_score(F.lit(seed), F.col("sample_id"))
    return selection.diverse_top_k(
        split, "source", "branch", "edit_type", F.lit(0), tie, order, most, stable_score(F.lit(seed), F.col("branch"), F.col("edit_type"))
    ).drop("pick")


def cap(edits: DataFrame, target: int, seed: int) -> DataFrame:
    return selection.stratified_cap(edits, "edit_type", "split", target, stable_score(F.lit(seed), F.col("sample_id")))


def chosen(edits: DataFrame, seed: int, target: int, most: int = 4) -> DataFrame:
    """``cap`` of ``select``, by keys alone: texts are stored once and read again for the ``target`` rows."""
    rows = stored(edits.withColumn("__row", F.monotonically_increasing_id()))
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // KEYS))
    keys = select(rows, seed, most, ["__row", "sample_id", "source", "branch", "edit_type"], tasks)
    kept = cap(stored(keys), target, seed).select("__row", "split")
    return rows.join(F.broadcast(kept), "__row").drop("__row")


def with_meta(edits: DataFrame, stage: str, version: str, seed: int) -> DataFrame:
    """``selection_meta`` says which stage picked a row; what it said before is the parent's."""
    had = "selection_meta" in edits.columns
    before = F.col("selection_meta.dataset_version") if had else F.lit(None).cast("string")
    meta = F.struct(
        F.col("split"), F.lit(stage).alias("pipeline_stage"), F.lit(version).alias("dataset_version"), before.alias("parent_dataset_version"),
        F.lit(True).alias("selected"), F.lit(seed).alias("selection_seed"),
    )
    return edits.withColumn("selection_meta", meta)


def instruct(edits: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """``instruction`` and why it is the template's; ``answers``: (sample_id, answer) of a model."""
    given = edits.withColumn("answer", F.lit(None).cast("string")) if answers is None else joins.lookup(
        edits, answers, "sample_id", [F.col("answer")]
    ).drop("matched")
    kind, edit, branch = F.col("edit_type"), F.col("edit"), F.col("branch")
    reasons = F.when(F.col("answer").isNull(), F.array(F.lit("dry_run"))).otherwise(I.validation_reasons(F.col("answer"), kind, edit, branch))
    out = given.withColumn("reasons", reasons).withColumn("fallback_used", F.size("reasons") > 0)
    text = F.when(F.col("fallback_used"), I.template(kind, edit, branch)).otherwise(F.trim("answer"))
    why = F.when(F.col("fallback_used"), I.summary(F.col("reasons")))
    return out.withColumn("instruction", text).withColumn("fallback_reason", why).drop("reasons", "answer")


def exports(records: DataFrame) -> dict[str, DataFrame]:
    """full_metadata, training and chat_sft of complete records."""
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    images = F.col("images") if "images" in records.columns else F.array().cast("array<string>")
    rows = records.withColumn("images", images)
    chat = F.array(
        message("system", F.lit(SYSTEM_TEXT)), message("user", F.concat(F.lit(USER_TEXT), "instruction")),
        message("assistant", F.concat(F.lit("<code>"), "target_code", F.lit("</code>"))),
    )
    return {
        "full_metadata": rows,
        "training": rows.select("split", *TRAINING_FIELDS),
        "chat_sft": rows.select("sample_id", "split", "images", chat.alias("messages")),
    }


def leaks(training: DataFrame) -> DataFrame:
    """Training rows whose instruction shows how the edit is made."""
    return training.filter(I.shows_code(F.col("instruction"), I.FINAL_CODE_WORDS)).select(
        "sample_id", F.lit("training_instruction_implementation_detail").alias("message")
    )


def category(images: Column) -> Column:
    return category_name(images)
