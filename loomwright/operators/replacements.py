"""Replacing a deleted feature: another shape in its source text, or a slot cut in its place.

Direct replacements rewrite the feature's own text (a circle becomes a hexagon, a
polygon its inscribed circle, a fillet a chamfer and back).  Slots are sized and
placed by the box of what the deletion changed, a fact column, and cut by a last
block of text.  All is expressions over ``candidates.deletion_candidates``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import float_text, with_steps
from ..functions.scalars import AXES, splice
from .placement import box_cutter, by_axis, centred_box, cut_by, r4

# A number in source text, the axis of each plane, and what becomes of each deletion.
NUMBER = r"([-+]?(?:\d+(?:\.\d*)?|\.\d+))"
PLANE_AXES = {"YZ": "x", "XZ": "y", "XY": "z"}
SLOT_TYPES = {
    "delete_hole": "replace_hole_with_slot",
    "delete_circular_cutout": "replace_circular_cutout_with_slot",
    "delete_polygonal_cutout": "replace_polygonal_cutout_with_slot",
}
LOOP_TYPE = "replace_loop_holes_with_slots"
DIRECT_TYPES = {
    "delete_circular_cutout": "replace_circular_cutout_with_polygonal_cutout",
    "delete_polygonal_cutout": "replace_polygonal_cutout_with_circular_cutout",
    "delete_chamfer": "replace_chamfer_with_fillet",
    "delete_fillet": "replace_fillet_with_chamfer",
}
SIDES = 6


def replaced_first(text: Column, pattern: str, new: Column | str) -> Column:
    """``text`` with the first match of ``pattern`` replaced ($1: its first group); null if there is none.

    ``new`` as a column must not hold $ or a backslash.
    """
    anchored = rf"^([\s\S]*?)(?:{pattern})"
    # The text before the match is group 1, so the pattern's own groups move up by one.
    if isinstance(new, str):
        new = F.lit(new.replace("$1", "$2"))
    return F.when(text.rlike(pattern), F.regexp_replace(text, F.lit(anchored), F.concat(F.lit("$1"), new)))


def direct_replacements(deletions: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(id, ordinal, edit_type, radius, sides, new_text, target_code) of ``deletions`` with their program in ``code``.

    Deletions without such a replacement, and those whose text hasn't the number
    that it needs, give no row.  Columns that ``keep`` names go along.
    """
    kind, block = F.col("edit_type"), F.col("block_text")
    across = F.when(kind == "delete_polygonal_cutout", r4(F.col("size") * F.cos(F.pi() / F.col("sides")))).otherwise(r4(F.col("size")))
    rows = with_steps(deletions, {"radius": across}).filter(F.col("radius") > 0)
    new = (
        F.when(kind == "delete_circular_cutout", replaced_first(block, rf"\.circle\s*\(\s*{NUMBER}\s*\)", f".polygon({SIDES}, $1)"))
        .when(kind == "delete_polygonal_cutout", replaced_first(block, rf"\.polygon\s*\(\s*\d+\s*,\s*{NUMBER}\s*\)", F.concat(F.lit(".circle("), float_text(F.col("radius")), F.lit(")"))))
        .when(kind == "delete_chamfer", replaced_first(block, rf"\.chamfer\s*\(\s*{NUMBER}\s*\)", ".fillet($1)"))
        .when(kind == "delete_fillet", replaced_first(block, rf"\.fillet\s*\(\s*{NUMBER}\s*\)", ".chamfer($1)"))
    )
    name = F.create_map(*[F.lit(x) for pair in DIRECT_TYPES.items() for x in pair])
    rows = with_steps(rows, {"new_text": new, "new_type": F.try_element_at(name, kind)}).filter("new_text is not null")
    return rows.select(
        "id", "ordinal", F.col("new_type").alias("edit_type"), "radius",
        F.when(kind == "delete_circular_cutout", SIDES).otherwise(F.col("sides")).cast("int").alias("sides"), "new_text",
        splice(F.col("code"), F.col("span_start"), F.col("span_end"), F.col("new_text")).alias("target_code"), *keep,
    )


def normal_axis(block: Column, dims: dict[str, Column]) -> Column:
    """The axis that a feature's text says it goes along, else the longest of what it changed."""
    out = None
    for a in AXES:
        for sign in (">", "<"):
            for quote in ('"', "'"):
                here = F.contains(block, F.lit(f".faces({quote}{sign}{a.upper()}{quote})"))
                out = F.when(here, a) if out is None else out.when(here, a)
    for plane, a in PLANE_AXES.items():
        for quote in ('"', "'"):
            out = out.when(F.contains(block, F.lit(f"Workplane({quote}{plane}{quote})")), a)
    x, y, z = (dims[a] for a in AXES)
    return out.otherwise(F.when((x >= y) & (x >= z), "x").when(y >= z, "y").otherwise("z"))


def slot_replacements(deletions: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Slots in the place of ``deletions``, with ``changed`` (the box that deleting changed) and ``part_dims`` (x, y, z of the part).

    (id, ordinal, edit_type, axis, length, width, depth, center, dims, affected,
    target_code); a slot that would be too short gives no row.  Columns that ``keep`` names go along.
    """
    kind, s = F.col("edit_type"), lambda name: {a: F.col(f"{name}.{a}") for a in AXES}
    rows = with_steps(deletions.filter(kind.isin(*SLOT_TYPES)), {"diameter": F.when(kind == "delete_hole", F.col("size")).otherwise(F.col("size") * 2)})
    rows = rows.filter("diameter > 0 and changed is not null")
    rows = with_steps(rows, {"gone": F.struct(*[r4(F.col(f"changed.{a}max") - F.col(f"changed.{a}min")).alias(a) for a in AXES])})
    rows = with_steps(rows, {"center": F.struct(*[r4((F.col(f"changed.{a}min") + F.col(f"changed.{a}max")) / 2).alias(a) for a in AXES])})
    rows = with_steps(rows, {"axis": normal_axis(F.col("block_text"), s("gone"))})
    axis = F.col("axis")
    t0 = F.when(axis == "x", "y").otherwise("x")
    t1 = F.when(axis == "z", "y").otherwise("z")
    wide = by_axis(t0, s("gone")) >= by_axis(t1, s("gone"))
    rows = with_steps(rows, {"major": F.when(wide, t0).otherwise(t1), "minor": F.when(wide, t1).otherwise(t0)})
    rows = with_steps(rows, {"long": by_axis(F.col("major"), s("gone")), "short": by_axis(F.col("minor"), s("gone")), "room": by_axis(F.col("major"), s("part_dims")) * 0.72})
    d, long, short, room = F.col("diameter"), F.col("long"), F.col("short"), F.col("room")
    circle, polygon, loop = kind == "delete_circular_cutout", kind == "delete_polygonal_cutout", F.col("repeats") > 1
    width = r4(
        F.when(circle, F.greatest(d * 0.5, F.lit(1.0))).when(polygon, F.greatest(d * 0.7, short * 0.7, F.lit(1.0)))
        .when(loop, F.greatest(d * 0.9, short * 0.35, F.lit(1.0))).otherwise(F.greatest(d * 0.75, F.lit(1.0)))
    )
    wanted = (
        F.when(circle, F.least(F.greatest(d * 1.2, long * 1.02), room)).when(polygon, F.least(F.greatest(d * 1.5, long * 1.15), room))
        .when(loop, F.greatest(d * 2.2, long * 1.05)).otherwise(F.greatest(d * 2.2, long * 1.8))
    )
    rows = with_steps(rows, {"width": width, "wanted": wanted})
    enough = F.when(circle, F.col("wanted") > F.col("width") * 1.3).when(polygon, F.col("wanted") > F.col("width") * 1.2).otherwise(True)
    rows = with_steps(rows.filter(enough), {"length": r4(F.col("wanted"))})
    rows = with_steps(rows, {"margin": r4(F.greatest(d * 0.15, F.lit(1.0)))})
    rows = with_steps(rows, {"depth": r4(by_axis(axis, s("gone")) + 2 * F.col("margin"))})
    dims = [F.when(axis == a, F.col("depth")).when(F.col("major") == a, F.col("length")).otherwise(F.col("width")).alias(a) for a in AXES]
    name = F.create_map(*[F.lit(x) for pair in SLOT_TYPES.items() for x in pair])
    # Only holes come in loops.
    rows = with_steps(rows, {"dims": F.struct(*dims), "edit_type": F.when(loop & (kind == "delete_hole"), LOOP_TYPE).otherwise(F.try_element_at(name, kind))})
    rows = with_steps(rows, {"candidate_id": F.concat_ws("_", "id", "ordinal", F.lit("slot"))})
    target = cut_by(F.col("target_code"), "V4 structural replacement", "v4_slot_cutter", box_cutter(s("dims"), s("center")))
    return rows.select(
        "id", "ordinal", "candidate_id", "edit_type", "axis", "length", "width", "depth", "center", "dims",
        centred_box(s("center"), s("dims")).alias("affected"), target.alias("target_code"), *keep,
    )
