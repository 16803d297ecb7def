"""Where a new hole, slot or pocket goes, and the text that cuts it.

Facts are columns: ``box`` (a struct of xmin .. zmax) and ``faces`` (an array of
structs of normal, an array of three numbers, and area) of the part.  All is
arithmetic in expressions; numbers are rounded to four places as Python does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import float_text, round_exact, with_steps
from ..functions.scalars import AXES

# Kinds of additions, the plane across each axis, the way it extrudes, and shares of sizes.
KINDS = ("add_through_hole", "add_blind_hole", "add_rectangular_slot", "add_pocket")
PLANES = {"x": "YZ", "y": "XZ", "z": "XY"}
EXTRUDES = {"x": 1.0, "y": -1.0, "z": 1.0}
FLAT = 0.95
OFF_CENTRE = 0.65


def r4(value: Column) -> Column:
    return round_exact(value, 4)


def by_axis(axis: Column, values: dict[str, Column]) -> Column:
    """The value of the axis that a column names."""
    return F.when(axis == "x", values["x"]).when(axis == "y", values["y"]).otherwise(values["z"])


def axis_of_normal(normal: Column, least: float = FLAT) -> Column:
    """struct(axis, side) of the axis that a normal lies along; null if it lies along none."""
    size = F.transform(normal, lambda v: F.abs(v))
    most = F.array_max(size)
    at = F.array_position(size, most)  # the first of equal ones
    axis = F.element_at(F.array(*[F.lit(a) for a in AXES]), at.cast("int"))
    side = F.when(F.element_at(normal, at.cast("int")) >= 0, "+").otherwise("-")
    return F.when(most >= least, F.struct(axis.alias("axis"), side.alias("side")))


def tangents(axis: Column) -> Column:
    """The two other axes, in order."""
    return F.when(axis == "x", F.array(F.lit("y"), F.lit("z"))).when(axis == "y", F.array(F.lit("x"), F.lit("z"))).otherwise(F.array(F.lit("x"), F.lit("y")))


def regions(faces: Column) -> Column:
    """Faces along an axis as (axis, side, area, number), the largest first, in given order where equal."""
    found = F.transform(faces, lambda f, i: F.struct((-r4(f["area"])).alias("less"), i.alias("number"), axis_of_normal(f["normal"]).alias("at"), r4(f["area"]).alias("area")))
    ordered = F.array_sort(F.filter(found, lambda r: r["at"].isNotNull()))
    return F.transform(ordered, lambda r: F.struct(r["at"]["axis"].alias("axis"), r["at"]["side"].alias("side"), r["area"].alias("area"), r["number"].alias("number")))


def chosen_region(faces: Column, dims: dict[str, Column]) -> Column:
    """The largest face on a positive side (on any side if there is none) of a part with a size across and along it."""
    every = regions(faces)
    solid = F.lit(True)
    for a in AXES:
        solid = solid & (dims[a] > 1e-6)
    positive = F.filter(every, lambda r: r["side"] == "+")
    return F.when(solid, F.try_element_at(F.when(F.size(positive) > 0, positive).otherwise(every), F.lit(1)))


def cylinder_box(origin: dict[str, Column], axis: Column, radius: Column, start: Column, end: Column) -> Column:
    """The box of a cylinder along an axis."""
    out = []
    for a in AXES:
        along = axis == a
        out.append(r4(F.when(along, F.least(start, end)).otherwise(origin[a] - radius)).alias(f"{a}min"))
        out.append(r4(F.when(along, F.greatest(start, end)).otherwise(origin[a] + radius)).alias(f"{a}max"))
    return F.struct(*out)


def centred_box(center: dict[str, Column], dims: dict[str, Column]) -> Column:
    out = []
    for a in AXES:
        out += [r4(center[a] - dims[a] / 2).alias(f"{a}min"), r4(center[a] + dims[a] / 2).alias(f"{a}max")]
    return F.struct(*out)


def triple(values: dict[str, Column]) -> Column:
    """(x, y, z) as Python writes it."""
    return F.concat(F.lit("("), F.concat_ws(", ", *[float_text(values[a]) for a in AXES]), F.lit(")"))


def add_candidates(parts: DataFrame, kinds: tuple[str, ...] = KINDS, keep: Sequence[str] = ()) -> DataFrame:
    """Additions to ``parts`` (id, code, box, faces): one of each kind on the chosen face, where it has room.

    Adds edit_type, candidate_id, axis, side, primitive (kind, radius, depth,
    dims, center), origin and extrude of the cut, affected (its box), hints
    (diameter, depth, length, width) and target_code.  Columns that ``keep`` names go along.
    """
    s = lambda name: {a: F.col(f"{name}.{a}") for a in AXES}
    steps = with_steps(parts, {"dims": F.struct(*[r4(F.col(f"box.{a}max") - F.col(f"box.{a}min")).alias(a) for a in AXES])})
    steps = with_steps(steps, {"middle": F.struct(*[r4((F.col(f"box.{a}min") + F.col(f"box.{a}max")) / 2).alias(a) for a in AXES])})
    steps = with_steps(steps, {"region": chosen_region(F.col("faces"), s("dims"))}).filter("region is not null")
    axis, side = F.col("region.axis"), F.col("region.side")
    steps = with_steps(steps, {"axis": axis, "side": side, "across": tangents(axis)})
    axis, side = F.col("axis"), F.col("side")
    t0, t1 = F.col("across")[0], F.col("across")[1]
    d0, d1 = by_axis(t0, s("dims")), by_axis(t1, s("dims"))
    steps = with_steps(
        steps,
        {
            "major": F.when(d0 >= d1, t0).otherwise(t1), "minor": F.when(d0 >= d1, t1).otherwise(t0),
            "narrow": F.least(d0, d1), "normal_size": by_axis(axis, s("dims")),
            "low": by_axis(axis, {a: F.col(f"box.{a}min") for a in AXES}), "high": by_axis(axis, {a: F.col(f"box.{a}max") for a in AXES}),
            "sign": by_axis(axis, {a: F.lit(v) for a, v in EXTRUDES.items()}),
        }
    )
    steps = with_steps(steps, {"margin": r4(F.greatest(F.col("narrow") * 0.08, F.col("normal_size") * 0.08, F.lit(1.0)))})
    steps = steps.filter("narrow > margin * 4 and normal_size > 1e-6")
    origin = []
    for a in AXES:
        off = r4(F.col(f"middle.{a}") + F.lit(OFF_CENTRE) * F.col(f"dims.{a}") / 2)
        on_face = F.when(side == "+", F.col(f"box.{a}max")).otherwise(F.col(f"box.{a}min"))
        origin.append(F.when(axis == a, on_face).when(F.col("major") == a, off).otherwise(F.col(f"middle.{a}")).alias(a))
    steps = with_steps(steps, {"place": F.struct(*origin)})
    steps = steps.withColumn("edit_type", F.explode(F.array(*[F.lit(k) for k in kinds])))
    margin, kind = F.col("margin"), F.col("edit_type")
    through, blind, slot = kind == "add_through_hole", kind == "add_blind_hole", kind == "add_rectangular_slot"
    round_, inward = through | blind, F.when(side == "+", F.lit(-1.0)).otherwise(F.lit(1.0))

    # Holes: a cylinder through the part, or to less than half its depth.
    steps = with_steps(steps, {"radius": F.when(round_, r4(F.greatest(F.col("narrow") * 0.05, margin * 0.75)))})
    steps = steps.filter(F.coalesce(F.col("radius") * 2 < F.col("narrow") - 2 * margin, F.lit(True)))
    from_side = F.when(F.col("sign") > 0, F.col("low") - margin).otherwise(F.col("high") + margin)
    from_face = F.when(side == "+", F.col("high") + margin * 0.05).otherwise(F.col("low") - margin * 0.05)
    steps = with_steps(
        steps,
        {
            "hole_depth": F.when(through, r4(F.col("normal_size") + 2 * margin)).when(blind, r4(F.greatest(F.col("normal_size") * 0.45, margin))),
            "start": F.when(through, from_side).when(blind, from_face),
        }
    )
    steps = with_steps(steps, {"whole": F.when(blind, r4(F.col("hole_depth") + margin * 0.1)).otherwise(F.col("hole_depth"))})
    steps = with_steps(
        steps,
        {
            "end": r4(F.col("start") + F.when(through, F.col("sign")).otherwise(inward) * F.col("whole")),
            "extrude": F.when(through, F.col("hole_depth")).when(blind, r4(inward / F.col("sign") * F.col("whole"))),
        }
    )

    # Slots and pockets: a box.
    major, minor, normal = by_axis(F.col("major"), s("dims")), by_axis(F.col("minor"), s("dims")), F.col("normal_size")
    length = r4(F.when(slot, F.greatest(margin * 2.0, major * 0.28)).otherwise(F.greatest(margin * 1.5, major * 0.22)))
    width = r4(F.when(slot, F.greatest(margin * 0.8, minor * 0.08)).otherwise(F.greatest(margin, minor * 0.12)))
    deep = r4(F.when(slot, normal + 2 * margin).otherwise(F.greatest(normal * 0.2, margin)))
    steps = with_steps(steps, {"length": F.when(~round_, length), "width": F.when(~round_, width), "deep": F.when(~round_, deep)})
    sizes = [F.when(F.col("major") == a, F.col("length")).when(F.col("minor") == a, F.col("width")).otherwise(F.col("deep")).alias(a) for a in AXES]
    sunk = by_axis(axis, s("place")) + inward * F.col("deep") / 2
    level = F.when(slot, r4((F.col("low") + F.col("high")) / 2)).otherwise(r4(sunk))
    center = [r4(F.when(~round_ & (axis == a), level).otherwise(F.col(f"place.{a}"))).alias(a) for a in AXES]
    steps = with_steps(steps, {"size": F.struct(*sizes), "center": F.struct(*center)})
    cut_from = [r4(F.when(axis == a, F.col("start")).otherwise(F.col(f"place.{a}"))).alias(a) for a in AXES]
    steps = with_steps(steps, {"cut_from": F.when(round_, F.struct(*cut_from))})
    affected = F.when(round_, cylinder_box(s("place"), axis, F.col("radius"), F.col("start"), F.col("end"))).otherwise(centred_box(s("center"), s("size")))
    steps = with_steps(
        steps,
        {
            "candidate_id": F.concat_ws("_", "id", "edit_type"),
            "plane": by_axis(axis, {a: F.lit(p) for a, p in PLANES.items()}),
            "affected": affected,
            "hints": F.struct(
                r4(F.col("radius") * 2).alias("diameter"), F.when(blind, F.col("hole_depth")).when(kind == "add_pocket", F.col("deep")).alias("depth"),
                F.col("length").alias("length"), F.col("width").alias("width"),
            ),
        }
    )
    steps = with_steps(steps, {"target_code": cut_by(F.col("code"), "V2 structural edit", "v2_cutter", cutter(round_))})
    return steps.select(
        "id", "candidate_id", "edit_type", "axis", "side", "plane", F.col("region.area").alias("face_area"),
        F.struct(
            F.when(round_, "cylinder").otherwise("box").alias("kind"), F.col("radius"), F.col("hole_depth").alias("depth"),
            F.when(~round_, F.col("size")).alias("dims"), F.col("center"),
        ).alias("primitive"),
        F.col("cut_from").alias("origin"), "extrude", "affected", "hints", "target_code", *keep,
    )


def cutter(round_: Column) -> Column:
    """The expression, as text, that makes the cutter of a row of ``add_candidates``."""
    s = lambda name: {a: F.col(f"{name}.{a}") for a in AXES}
    hole = F.concat(
        F.lit("cq.Workplane('"), F.col("plane"), F.lit("', origin="), triple(s("cut_from")), F.lit(").circle("), float_text(F.col("radius")),
        F.lit(").extrude("), float_text(F.col("extrude")), F.lit(")"),
    )
    return F.when(round_, hole).otherwise(box_cutter(s("size"), s("center")))


def box_cutter(dims: dict[str, Column], center: dict[str, Column]) -> Column:
    sizes = F.concat_ws(", ", *[float_text(dims[a]) for a in AXES])
    return F.concat(F.lit("cq.Workplane('XY').box("), sizes, F.lit(").translate("), triple(center), F.lit(")"))


def cut_by(code: Column, title: str, name: str, made: Column) -> Column:
    """``code`` with a last block that makes a cutter and cuts it from the result."""
    note = F.concat(F.lit(f"# {title}: "), F.col("edit_type"), F.lit(" ("), F.col("candidate_id"), F.lit(")"))
    lines = [F.regexp_replace(code, r"\s+\z", ""), F.lit(""), note, F.concat(F.lit(f"{name} = "), made), F.lit(f"result = result.cut({name})"), F.lit("")]
    return F.concat_ws("\n", *lines)
