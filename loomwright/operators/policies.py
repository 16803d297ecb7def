"""Acceptance of edits as predicates over measured facts.

Facts are columns: volumes before and after, boxes, and the boxes and volumes of
regions that changed (null where nothing did).  How they are measured isn't known
here.  Each policy gives its checks by name, in order; ``report`` makes a verdict
of them and ``by_edit_type`` picks the policy that an edit's type asks for.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.numbers import round_exact
from ..functions.scalars import AXES, box_center_distance, box_dims, box_expanded, box_same, box_within
from .rules import failed_checks

# Tolerances, the names of checks (in each policy below), modes, and edit types by policy.
TINY, TOLERANCE, MISMATCH = 1e-6, 1e-3, 0.25
LOCAL_SHARE, REACH = 0.8, 0.02
MODES = {"parameter": "cadquery", "add": "cadquery_structural", "delete": "cadquery_structural_delete", "replace": "cadquery_structural_replace"}
ADD_TYPES = ("add_through_hole", "add_blind_hole", "add_rectangular_slot", "add_pocket")
CUTOUT_DELETE_TYPES = ("delete_hole", "delete_circular_cutout", "delete_polygonal_cutout")
FINISHING_DELETE_TYPES = ("delete_fillet", "delete_chamfer")
SLOT_REPLACE_TYPES = (
    "replace_hole_with_slot", "replace_loop_holes_with_slots", "replace_circular_cutout_with_slot", "replace_polygonal_cutout_with_slot",
)
CUTOUT_REPLACE_TYPES = ("replace_circular_cutout_with_polygonal_cutout", "replace_polygonal_cutout_with_circular_cutout")
FINISHING_REPLACE_TYPES = ("replace_chamfer_with_fillet", "replace_fillet_with_chamfer")

Box = dict[str, Column]
Checks = dict[str, Column]


def box_of(column: str) -> Box:
    """The limits in a struct column."""
    return {f"{a}{end}": F.col(f"{column}.{a}{end}") for a in AXES for end in ("min", "max")}


def change(after: Column, before: Column) -> Column:
    return round_exact(after - before, 4)


def not_collapsed(after: Box, before: Box) -> Column:
    """Every side is still over half as long."""
    out = F.lit(True)
    for a, b in zip(box_dims(after), box_dims(before), strict=True):
        out = out & (a > F.greatest(b * 0.5, F.lit(TINY)))
    return out


def not_global(changed: Box, whole: Box) -> Column:
    """At least two sides of the changed region are clearly shorter than the part's."""
    sides = zip(box_dims(changed), box_dims(whole), strict=True)
    return sum(((c <= F.greatest(w * LOCAL_SHARE, F.lit(TINY))).cast("int") for c, w in sides), F.lit(0)) >= 2


def close_to(change_: Column, volume: Column) -> Column:
    return F.abs(change_ - volume) <= F.greatest(change_ * MISMATCH, F.lit(TOLERANCE))


def there(volume: Column) -> Column:
    return F.coalesce(volume > TINY, F.lit(False))


def over_noise(amount: Column, whole: Column) -> Column:
    return amount > F.greatest(whole * 1e-7, F.lit(1e-4))


def parameter(before: Column, after: Column, parses: Column, has_result: Column) -> Checks:
    """A scaled number: both programs run (their volumes are known) and the new one defines its result."""
    return {"parses": parses, "result_defined": has_result, "original_executes": before.isNotNull(), "edited_executes": after.isNotNull()}


def added(before: Column, after: Column, box0: Box, box1: Box, affected: Box, changed: Column, changed_box: Box) -> Checks:
    """A hole, slot or pocket that is cut."""
    delta, reach = change(after, before), F.greatest(*box_dims(box0)) * REACH
    return {
        "original_executes": before > TINY,
        "edited_executes": after > TINY,
        "edited_non_empty": after > TINY,
        "volume_direction_ok": delta < -TINY,
        "bbox_growth_ok": box_within(box1, box_expanded(box0, TOLERANCE)),
        "bbox_not_collapsed": not_collapsed(box1, box0),
        "locality_ok": there(changed) & box_within(changed_box, box_expanded(affected, reach), TOLERANCE),
        "volume_delta_matches_changed_region": close_to(F.abs(delta), changed),
    }


def cutout_deleted(before: Column, after: Column, box0: Box, box1: Box, changed: Column, changed_box: Box) -> Checks:
    """A hole or cutout that is filled."""
    delta = change(after, before)
    return {
        "original_executes": before > TINY,
        "edited_executes": after > TINY,
        "edited_non_empty": after > TINY,
        "volume_direction_ok": delta > TINY,
        "bbox_stable": box_same(box1, box0, TOLERANCE),
        "bbox_not_collapsed": not_collapsed(box1, box0),
        "changed_region_non_empty": there(changed),
        "changed_region_not_global": not_global(changed_box, box0),
        "volume_delta_matches_changed_region": close_to(delta, changed),
    }


def finishing_deleted(before: Column, after: Column, box0: Box, box1: Box, more: Column, less: Column) -> Checks:
    """A fillet or chamfer that is left out; ``more``, ``less``: volumes of what was added and removed."""
    moved = round_exact(F.coalesce(F.when(more > TINY, more), F.lit(0.0)) + F.coalesce(F.when(less > TINY, less), F.lit(0.0)), 4)
    return {
        "original_executes": before > TINY,
        "edited_executes": after > TINY,
        "edited_non_empty": after > TINY,
        "bbox_stable": box_same(box1, box0, TOLERANCE),
        "bbox_not_collapsed": not_collapsed(box1, box0),
        "volume_changed_nontrivially": over_noise(F.abs(change(after, before)), before),
        "geometry_changed_nontrivially": over_noise(moved, before),
    }


def _final_change(whole: Box, removed: Column, removed_box: Box, more: Column, more_box: Box) -> Checks:
    local = (~there(removed) | not_global(removed_box, whole)) & (~there(more) | not_global(more_box, whole))
    return {"final_change_local": local, "final_has_geometric_change": there(removed) | there(more)}


def slot_replaced(
    delete_ok: Column, before: Column, deleted: Column, after: Column, box0: Box, box_deleted: Box, box1: Box,
    slot: Column, slot_box: Box, slot_dims: list[Column], planned: Box, old_box: Box,
    removed: Column, removed_box: Box, more: Column, more_box: Box,
) -> Checks:
    """A feature that is filled and a slot that is cut in its place.

    ``slot``, ``slot_box``: what the cut took; ``planned``: the slot's own box;
    ``old_box``: what the deletion filled.
    """
    reach = F.greatest(*box_dims(box_deleted)) * REACH
    local = not_global(slot_box, box_deleted) & box_within(slot_box, box_expanded(planned, reach), TOLERANCE)
    near = box_center_distance(slot_box, old_box) <= F.greatest(*slot_dims)
    return {
        "delete_stage_ok": delete_ok,
        "original_executes": before > TINY,
        "deleted_executes": deleted > TINY,
        "replaced_executes": after > TINY,
        "replaced_non_empty": after > TINY,
        "delete_volume_increased": change(deleted, before) > TINY,
        "slot_volume_decreased_from_deleted": change(after, deleted) < -TINY,
        "bbox_stable_original_to_deleted": box_same(box_deleted, box0, TOLERANCE),
        "bbox_stable_deleted_to_replaced": box_within(box1, box_expanded(box_deleted, TOLERANCE)),
        "bbox_not_collapsed": not_collapsed(box1, box0),
        "slot_changed_region_non_empty": there(slot),
        "slot_changed_region_local": there(slot) & local,
        "slot_near_deleted_hole": there(slot) & near,
        **_final_change(box0, removed, removed_box, more, more_box),
    }


def cutout_replaced(
    delete_ok: Column, before: Column, deleted: Column, after: Column, box0: Box, box_deleted: Box, box1: Box,
    new: Column, new_box: Box, old_box: Box, removed: Column, removed_box: Box, more: Column, more_box: Box,
) -> Checks:
    """A cutout that gets another shape."""
    near = box_center_distance(new_box, old_box) <= F.greatest(*box_dims(old_box), *box_dims(new_box))
    return {
        "delete_stage_ok": delete_ok,
        "original_executes": before > TINY,
        "deleted_executes": deleted > TINY,
        "replaced_executes": after > TINY,
        "replaced_non_empty": after > TINY,
        "bbox_stable_original_to_deleted": box_same(box_deleted, box0, TOLERANCE),
        "bbox_stable_original_to_replaced": box_same(box1, box0, TOLERANCE),
        "bbox_not_collapsed": not_collapsed(box1, box0),
        "new_feature_changed_region_non_empty": there(new),
        "new_feature_changed_region_local": there(new) & not_global(new_box, box_deleted),
        "new_feature_near_old_feature": there(new) & near,
        **_final_change(box0, removed, removed_box, more, more_box),
    }


def finishing_replaced(before: Column, after: Column, box0: Box, box1: Box, removed: Column, more: Column) -> Checks:
    """A fillet that becomes a chamfer, or the other way."""
    moved = F.coalesce(F.when(removed > TINY, removed), F.lit(0.0)) + F.coalesce(F.when(more > TINY, more), F.lit(0.0))
    return {
        "original_executes": before > TINY,
        "replaced_executes": after > TINY,
        "replaced_non_empty": after > TINY,
        "bbox_stable": box_same(box1, box0, TOLERANCE),
        "bbox_not_collapsed": not_collapsed(box1, box0),
        "volume_changed_nontrivially": over_noise(F.abs(change(after, before)), before),
        "geometry_changed_nontrivially": over_noise(moved, before),
    }


def accepted(checks: Checks) -> Column:
    out = F.lit(True)
    for c in checks.values():
        out = out & F.coalesce(c, F.lit(False))
    return out


def report(checks: Checks, mode: str, error: Column | None = None) -> Column:
    """struct(ok, mode, checks, errors); ``error``: of measuring, which fails the edit."""
    made = F.create_map(*[x for n, c in checks.items() for x in (F.lit(n), F.coalesce(c, F.lit(False)))])
    errors, ok = failed_checks(checks), accepted(checks)
    if error is not None:
        errors = F.when(error.isNotNull(), F.array(error)).otherwise(errors)
        ok = ok & error.isNull()
    return F.struct(ok.alias("ok"), F.lit(mode).alias("mode"), made.alias("checks"), errors.alias("errors"))


def by_edit_type(edit_type: Column, reports: dict[tuple[str, ...], Column], otherwise: Column) -> Column:
    """The report of the policy whose types have the edit's."""
    out = None
    for types, made in reports.items():
        here = edit_type.isin(*types)
        out = F.when(here, made) if out is None else out.when(here, made)
    return otherwise if out is None else out.otherwise(otherwise)


def summary(made: Column, most: int = 20) -> Column:
    """struct(ok, mode, passed: the first names of checks that hold) of a report."""
    passed = F.filter(F.map_keys(made["checks"]), lambda k: F.element_at(made["checks"], k))
    return F.struct(made["ok"].alias("ok"), made["mode"].alias("mode"), F.slice(passed, 1, most).alias("passed"))
