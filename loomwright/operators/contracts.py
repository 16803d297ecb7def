"""Contracts of JSON records, one for each stage's files, as rules over a VARIANT column.

A contract is a list of (message, condition of failure).  Paths that a record
hasn't are null, so conditions say what must be there.  What a program's text is
worth, whether it parses, is a column that ``with_parsed`` adds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ..functions.instructions import FINAL_CODE_WORDS, shows_code
from ..functions.programs import is_program
from ..functions.records import forbidden_fields
from ..functions.scalars import AXES
from . import policies as P
from .rules import Rules, all_reasons

# Fields of the records, the calls that features come from, and names of checks.
CANDIDATE = ["candidate_id", "sample_index", "source_line", "images", "original_code"]
PARAMETER = ["kind", "call", "arg_index", "old", "new", "matched_text", "span_start", "span_end", "replacement", "scale_factor"]
ADDITION = ["edit_type", "target_region", "primitive", "insertion_strategy", "affected_region_bbox", "instruction_template"]
DELETION = ["candidate_type", "edit_type", "source_api", "block_span_start", "block_span_end", "block_text", "parameters", "expected_effect", "instruction_hints"]
REPLACEMENT = ["candidate_type", "edit_type", "old_feature", "new_feature", "insertion_strategy", "instruction_template", "instruction_hints"]
VALIDATED = ["target_code", "edit_record", "validation_report", "fallback_instruction"]
SOURCE_CALLS = ["hole", "cut", "cut_polygon", "fillet", "chamfer"]
TRAINING_FIELDS = ["sample_id", "images", "instruction", "target_code"]
HIDDEN_FIELDS = {
    "source_sample_id", "metadata", "hidden", "original_code", "intermediate_code", "edit_record", "validation_report", "selection_meta",
    "instruction_meta",
}
ADD_CHECKS = [
    "original_executes", "edited_executes", "edited_non_empty", "volume_direction_ok", "bbox_growth_ok", "bbox_not_collapsed", "locality_ok",
    "volume_delta_matches_changed_region",
]
DELETE_CHECKS = [
    "original_executes", "edited_executes", "edited_non_empty", "volume_direction_ok", "bbox_stable", "bbox_not_collapsed",
    "changed_region_non_empty", "changed_region_not_global", "volume_delta_matches_changed_region",
]
FINISHING_DELETE_CHECKS = [
    "original_executes", "edited_executes", "edited_non_empty", "bbox_stable", "bbox_not_collapsed", "volume_changed_nontrivially",
    "geometry_changed_nontrivially",
]
SLOT_CHECKS = [
    "delete_stage_ok", "original_executes", "deleted_executes", "replaced_executes", "replaced_non_empty", "delete_volume_increased",
    "slot_volume_decreased_from_deleted", "bbox_stable_original_to_deleted", "bbox_stable_deleted_to_replaced", "bbox_not_collapsed",
    "slot_changed_region_non_empty", "slot_changed_region_local", "slot_near_deleted_hole", "final_change_local", "final_has_geometric_change",
]
CUTOUT_CHECKS = [
    "delete_stage_ok", "original_executes", "deleted_executes", "replaced_executes", "replaced_non_empty", "bbox_stable_original_to_deleted",
    "bbox_stable_original_to_replaced", "bbox_not_collapsed", "new_feature_changed_region_non_empty", "new_feature_changed_region_local",
    "new_feature_near_old_feature", "final_change_local", "final_has_geometric_change",
]
FINISHING_CHECKS = [
    "original_executes", "replaced_executes", "replaced_non_empty", "bbox_stable", "bbox_not_collapsed", "volume_changed_nontrivially",
    "geometry_changed_nontrivially",
]
NEW_FEATURES = {
    "replace_circular_cutout_with_polygonal_cutout": "polygonal_cutout", "replace_polygonal_cutout_with_circular_cutout": "circular_cutout",
    "replace_chamfer_with_fillet": "fillet", "replace_fillet_with_chamfer": "chamfer",
}
OLD_FEATURES = {
    "replace_circular_cutout_with_polygonal_cutout": "delete_circular_cutout", "replace_polygonal_cutout_with_circular_cutout": "delete_polygonal_cutout",
    "replace_chamfer_with_fillet": "delete_chamfer", "replace_fillet_with_chamfer": "delete_fillet",
}


def parses(code: Column) -> Column:
    """Whether a text is a program by its syntax; it is only parsed, never run."""

    @F.pandas_udf("boolean")
    def run(codes: pd.Series) -> pd.Series:
        return pd.Series([is_program(c) for c in codes], dtype=bool)

    return run(code)


def with_parsed(df: DataFrame, code: str, name: str) -> DataFrame:
    """``df`` with whether its column ``code`` is a program by its syntax, as a step of its own that filters may read."""
    at = df.columns.index(code)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = pa.array([is_program(c.as_py()) for c in batch.column(at)], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns, flags], names=[*batch.schema.names, name])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(name, BooleanType())]))


class Record:
    """Conditions on paths of a record in the VARIANT column ``record``."""

    def __init__(self, column: str = "record"):
        self.v = F.col(column)

    def part(self, path: str) -> Column:
        return F.try_variant_get(self.v, f"$.{path}", "variant")

    def kind(self, path: str) -> Column:
        """The part's type: OBJECT, ARRAY, STRING, BIGINT, ...; empty if it isn't there."""
        return F.coalesce(F.regexp_extract(F.schema_of_variant(self.part(path)), r"^[A-Z]+", 0), F.lit(""))

    def text(self, path: str) -> Column:
        return F.when(self.kind(path) == "STRING", F.try_variant_get(self.v, f"$.{path}", "string"))

    def number(self, path: str) -> Column:
        return F.when(self.is_number(path), F.try_variant_get(self.v, f"$.{path}", "double"))

    def there(self, path: str) -> Column:
        return self.part(path).isNotNull()

    def is_number(self, path: str) -> Column:
        return self.kind(path).isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DECIMAL", "DOUBLE", "FLOAT")

    def is_whole(self, path: str) -> Column:
        return F.schema_of_variant(self.part(path)).isin("BIGINT", "INT", "SMALLINT", "TINYINT")

    def is_object(self, path: str) -> Column:
        return self.kind(path) == "OBJECT"

    def filled(self, path: str) -> Column:
        return F.coalesce(F.trim(self.text(path)) != "", F.lit(False))

    def true(self, path: str) -> Column:
        return F.coalesce(F.try_variant_get(self.v, f"$.{path}", "boolean"), F.lit(False)) & (self.kind(path) == "BOOLEAN")

    def strings(self, path: str, least: int = 0) -> Column:
        shape = F.schema_of_variant(self.part(path))
        return F.coalesce(shape == "ARRAY<STRING>", F.lit(False)) | (F.lit(least == 0) & F.coalesce(shape == "ARRAY<VOID>", F.lit(False)))

    # Rules.

    def needs(self, paths: list[str], said: str = "missing {}", inside: str = "") -> Rules:
        """Each path must be there, in the object ``inside`` if it is one."""
        given = self.is_object(inside) if inside else F.lit(True)
        return [(said.format(p), given & ~self.there(f"{inside}.{p}" if inside else p)) for p in paths]

    def lacks(self, path: str, said: str) -> Rules:
        return [(said, self.there(path))]

    def an_object(self, path: str, said: str | None = None) -> Rules:
        return [(said or f"{path} must be an object", ~self.is_object(path))]

    def program(self, path: str, parsed: bool = True) -> Rules:
        out = [(f"{path} must be non-empty", ~self.filled(path))]
        return [*out, (f"{path} syntax error", self.filled(path) & ~F.coalesce(F.col(f"parses_{path.split('.')[-1]}"), F.lit(False)))] if parsed else out

    def box(self, path: str, label: str, given: Column | None = None) -> Rules:
        given = F.lit(True) if given is None else given
        ends = [f"{a}{e}" for a in AXES for e in ("min", "max")]
        whole = self.is_object(path)
        every = whole
        for e in ends:
            every = every & self.is_number(f"{path}.{e}")
        out = [(f"{label} must be an object", given & ~whole)]
        out += [(f"{label}.{e} must be numeric", given & whole & ~self.is_number(f"{path}.{e}")) for e in ends]
        for a in AXES:
            disordered = self.number(f"{path}.{a}min") >= self.number(f"{path}.{a}max")
            out.append((f"{label}.{a}min must be smaller than {a}max", given & every & F.coalesce(disordered, F.lit(False))))
        return out

    def held(self, path: str, checks: list[str], given: Column) -> Rules:
        given = given & self.is_object(path)
        return [(f"{path}.{c} must be true", given & ~self.true(f"{path}.{c}")) for c in checks]

    def report(self, mode: str, checks: list[tuple[list[str], Column]]) -> Rules:
        at = "validation_report"
        given = self.is_object(at)
        out = [*self.an_object(at), (f"{at}.ok must be true", given & ~self.true(f"{at}.ok"))]
        out.append((f"{at}.mode must be {mode}", given & ~F.coalesce(self.text(f"{at}.mode") == mode, F.lit(False))))
        out.append((f"{at}.checks must be an object", given & ~self.is_object(f"{at}.checks")))
        for names, when in checks:
            out += self.held(f"{at}.checks", names, when)
        return out


def _images(r: Record) -> Rules:
    return [("images must be a string list", ~r.strings("images"))]


def parameter_candidate(r: Record) -> Rules:
    at, given = "edit_candidate", r.is_object("edit_candidate")
    backwards = r.is_whole(f"{at}.span_start") & r.is_whole(f"{at}.span_end") & (r.number(f"{at}.span_start") >= r.number(f"{at}.span_end"))
    return [
        *r.lacks("target_code", "candidate record must not contain target_code"),
        *r.lacks("validation_report", "candidate record must not contain validation_report"),
        *r.needs([*CANDIDATE, at]), *_images(r), *r.program("original_code", parsed=False), *r.an_object(at),
        *r.needs(PARAMETER, f"{at} missing {{}}", at), (f"{at} span_start must be before span_end", given & F.coalesce(backwards, F.lit(False))),
    ]


def _starts_add(r: Record, at: str) -> Rules:
    return [(f"{at}.edit_type must be add-only", r.is_object(at) & ~F.coalesce(r.text(f"{at}.edit_type").startswith("add_"), F.lit(False)))]


def add_candidate(r: Record) -> Rules:
    at, given = "structural_candidate", r.is_object("structural_candidate")
    solid = r.is_object("original_geometry")
    return [
        *r.needs([*CANDIDATE, "original_geometry", at]),
        *r.lacks("target_code", "structural candidate must not contain target_code"),
        *r.lacks("validation_report", "structural candidate must not contain validation_report"),
        *_images(r), *r.program("original_code", parsed=False), *r.an_object("original_geometry"),
        ("original_geometry.volume must be positive", solid & ~F.coalesce(r.number("original_geometry.volume") > 0, F.lit(False))),
        *r.box("original_geometry.bbox", "original_geometry.bbox", solid), *r.an_object(at), *r.needs(ADDITION, f"{at} missing {{}}", at),
        *_starts_add(r, at), *r.box(f"{at}.affected_region_bbox", f"{at}.affected_region_bbox", given),
        *[(f"{at}.{x} must be an object", given & ~r.is_object(f"{at}.{x}")) for x in ("target_region", "primitive", "insertion_strategy")],
        ("insertion_strategy.append_csg_block must be true", given & r.is_object(f"{at}.insertion_strategy") & ~r.true(f"{at}.insertion_strategy.append_csg_block")),
    ]


def delete_candidate(r: Record) -> Rules:
    at, given, kind = "delete_candidate", r.is_object("delete_candidate"), r.text("delete_candidate.edit_type")
    start, end = r.number(f"{at}.block_span_start"), r.number(f"{at}.block_span_end")
    ordered = F.coalesce(r.is_whole(f"{at}.block_span_start") & r.is_whole(f"{at}.block_span_end") & (start < end), F.lit(False))
    code, block = r.text("original_code"), r.text(f"{at}.block_text")
    there = code.substr((start + 1).cast("int"), (end - start).cast("int"))
    listed = r.is_object(f"{at}.parameters")
    lacking = lambda kinds, ok: given & listed & F.coalesce(kind.isin(*kinds), F.lit(False)) & ~ok
    number = lambda n: r.is_number(f"{at}.parameters.{n}")
    return [
        *r.needs([*CANDIDATE, "original_geometry", at]),
        *r.lacks("target_code", "delete candidate must not contain target_code"),
        *r.lacks("validation_report", "delete candidate must not contain validation_report"),
        *r.program("original_code", parsed=False), *r.an_object(at), *r.needs(DELETION, f"{at} missing {{}}", at),
        *_delete_type(r),
        (f"{at}.source_api is unsupported", given & ~F.coalesce(r.text(f"{at}.source_api").isin(*SOURCE_CALLS), F.lit(False))),
        (f"{at} block span must be a valid integer range", given & ~ordered),
        (f"{at} block span does not match block_text", given & ordered & F.coalesce(there != block, F.lit(False))),
        (f"{at}.parameters must be an object", given & ~listed),
        (f"{at}.parameters.diameter must be numeric", lacking(["delete_hole", "delete_circular_cutout"], number("diameter"))),
        (f"{at}.parameters.sides and radius are required for polygonal cutout", lacking(["delete_polygonal_cutout"], F.coalesce(r.is_whole(f"{at}.parameters.sides"), F.lit(False)) & number("radius"))),
        (f"{at}.parameters.radius must be numeric for fillet", lacking(["delete_fillet"], number("radius"))),
        (f"{at}.parameters.distance must be numeric for chamfer", lacking(["delete_chamfer"], number("distance"))),
    ]


def _delete_type(r: Record) -> Rules:
    at, given = "delete_candidate", r.is_object("delete_candidate")
    kinds = [*P.CUTOUT_DELETE_TYPES, *P.FINISHING_DELETE_TYPES]
    return [
        (f"{at}.candidate_type must be structural_delete", given & ~F.coalesce(r.text(f"{at}.candidate_type") == "structural_delete", F.lit(False))),
        (f"{at}.edit_type is unsupported", given & ~F.coalesce(r.text(f"{at}.edit_type").isin(*kinds), F.lit(False))),
    ]


def _replacement(r: Record) -> Rules:
    at, given, kind = "replace_candidate", r.is_object("replace_candidate"), r.text("replace_candidate.edit_type")
    every = [*P.SLOT_REPLACE_TYPES, *P.CUTOUT_REPLACE_TYPES, *P.FINISHING_REPLACE_TYPES]
    of = lambda *kinds: given & F.coalesce(kind.isin(*kinds), F.lit(False))
    shape = lambda name, field: ~F.coalesce(r.text(f"{at}.new_feature.{field}") == name, F.lit(False))
    new, plan = r.is_object(f"{at}.new_feature"), r.is_object(f"{at}.insertion_strategy")
    return [
        *r.an_object(at),
        (f"{at}.candidate_type must be structural_replace", given & ~F.coalesce(r.text(f"{at}.candidate_type") == "structural_replace", F.lit(False))),
        (f"{at}.edit_type must be a supported V4 replace edit", given & ~F.coalesce(kind.isin(*every), F.lit(False))),
        (f"{at}.old_feature must be an object", given & ~r.is_object(f"{at}.old_feature")),
        (f"{at}.new_feature must be an object", given & ~new),
        (f"{at}.new_feature.feature must be rectangular_slot", of(*P.SLOT_REPLACE_TYPES) & new & shape("rectangular_slot", "feature")),
        *[(f"{at}.new_feature must describe a {name}", of(k) & new & shape(name, "feature_type")) for k, name in NEW_FEATURES.items()],
        (f"{at}.insertion_strategy must be an object", given & ~plan),
        ("slot replace insertion_strategy.append_csg_block must be true", of(*P.SLOT_REPLACE_TYPES) & plan & ~r.true(f"{at}.insertion_strategy.append_csg_block")),
        ("direct replace insertion_strategy.method must be direct_source_replacement",
         of(*P.CUTOUT_REPLACE_TYPES, *P.FINISHING_REPLACE_TYPES) & plan & ~F.coalesce(r.text(f"{at}.insertion_strategy.method") == "direct_source_replacement", F.lit(False))),
    ]


def replace_candidate(r: Record) -> Rules:
    at, kind = "replace_candidate", r.text("replace_candidate.edit_type")
    old = r.is_object(f"{at}.old_feature")
    was = r.text(f"{at}.old_feature.edit_type")
    slot = r.is_object(at) & F.coalesce(kind.isin(*P.SLOT_REPLACE_TYPES), F.lit(False))
    return [
        *r.needs([*CANDIDATE, "intermediate_code", "target_code", "delete_validation_report", at, "validation_report"]), *_images(r),
        *r.program("original_code"), *r.program("intermediate_code"), *r.program("target_code"), *r.needs(REPLACEMENT, f"{at} missing {{}}", at),
        *_replacement(r),
        ("slot replace old_feature.edit_type must be delete_hole/delete_circular_cutout/delete_polygonal_cutout",
         slot & old & ~F.coalesce(was.isin(*P.CUTOUT_DELETE_TYPES), F.lit(False))),
        *[(f"{k}: old_feature.edit_type must be {name}", r.is_object(at) & F.coalesce(kind == k, F.lit(False)) & old & ~F.coalesce(was == name, F.lit(False)))
          for k, name in OLD_FEATURES.items()],
        ("replace_candidate.new_feature must describe a six-sided polygonal_cutout",
         F.coalesce(kind == "replace_circular_cutout_with_polygonal_cutout", F.lit(False)) & r.is_object(f"{at}.new_feature") & ~F.coalesce(r.number(f"{at}.new_feature.sides") == 6, F.lit(False))),
        *r.box(f"{at}.new_feature.affected_region_bbox", f"{at}.new_feature.affected_region_bbox", slot & r.is_object(f"{at}.new_feature")),
        *r.an_object("delete_validation_report"), *r.an_object("validation_report"),
        ("validation_report.mode must be cadquery_structural_replace",
         r.is_object("validation_report") & ~F.coalesce(r.text("validation_report.mode") == P.MODES["replace"], F.lit(False))),
    ]


def _validated(r: Record, said: str) -> Rules:
    return [*r.lacks("instruction", said), *r.program("target_code"), ("fallback_instruction must be non-empty", ~r.filled("fallback_instruction"))]


def validated_parameter(r: Record) -> Rules:
    some = r.strings("images", least=1)
    given = r.is_object("validation_report")
    return [
        *r.needs([*CANDIDATE, "edit_candidate", *VALIDATED]), *_validated(r, "validated edit record should not contain final instruction"),
        ("images must be a non-empty string list", ~some), *r.program("original_code", parsed=False), *r.an_object("validation_report"),
        ("validation_report.ok must be true", given & ~r.true("validation_report.ok")), *r.an_object("edit_candidate"), *r.an_object("edit_record"),
    ]


def validated_add(r: Record) -> Rules:
    at, given = "structural_candidate", r.is_object("structural_candidate")
    falls = F.coalesce(r.number("validation_report.volume_delta") < 0, F.lit(False))
    return [
        *r.needs(["candidate_id", "images", "original_code", at, *VALIDATED]), *_validated(r, "validated structural edit must not contain final instruction"),
        *r.program("original_code", parsed=False), *r.an_object(at), *_starts_add(r, at),
        (f"{at}.insertion_strategy.append_csg_block must be true", given & ~r.true(f"{at}.insertion_strategy.append_csg_block")),
        *r.report(P.MODES["add"], [(ADD_CHECKS, F.lit(True))]),
        ("validation_report.volume_delta must be negative for V2 subtractive add edits", r.is_object("validation_report") & ~falls),
    ]


def validated_delete(r: Record) -> Rules:
    at, delta, given = "delete_candidate", r.number("validation_report.volume_delta"), r.is_object("validation_report")
    finishing = F.coalesce(r.text(f"{at}.edit_type").isin(*P.FINISHING_DELETE_TYPES), F.lit(False))
    return [
        *r.needs(["candidate_id", "images", "original_code", at, *VALIDATED]), *_validated(r, "validated delete edit must not contain final instruction"),
        *r.an_object(at), *_delete_type(r),
        ("target_code still contains deleted block_text", F.coalesce(F.contains(r.text("target_code"), r.text(f"{at}.block_text")), F.lit(False))),
        *r.report(P.MODES["delete"], [(FINISHING_DELETE_CHECKS, finishing), (DELETE_CHECKS, ~finishing)]),
        ("validation_report.volume_delta must be non-zero for finishing delete", given & finishing & ~F.coalesce(F.abs(delta) > 0, F.lit(False))),
        ("validation_report.volume_delta must be positive for structural delete", given & ~finishing & ~F.coalesce(delta > 0, F.lit(False))),
    ]


def validated_replace(r: Record) -> Rules:
    kind, given = r.text("replace_candidate.edit_type"), r.is_object("validation_report")
    cutout, finishing, slot = (F.coalesce(kind.isin(*k), F.lit(False)) for k in (P.CUTOUT_REPLACE_TYPES, P.FINISHING_REPLACE_TYPES, P.SLOT_REPLACE_TYPES))
    number = lambda n: r.number(f"validation_report.{n}")
    return [
        *r.needs(["candidate_id", "images", "original_code", "intermediate_code", "replace_candidate", *VALIDATED]),
        *_validated(r, "validated replace edit must not contain final instruction"), *r.program("original_code"), *r.program("intermediate_code"),
        *_replacement(r), *r.report(P.MODES["replace"], [(CUTOUT_CHECKS, cutout), (FINISHING_CHECKS, finishing), (SLOT_CHECKS, ~cutout & ~finishing)]),
        ("validation_report.delete_volume_delta must be positive", given & slot & ~F.coalesce(number("delete_volume_delta") > 0, F.lit(False))),
        ("validation_report.slot_volume_delta must be negative", given & slot & ~F.coalesce(number("slot_volume_delta") < 0, F.lit(False))),
    ]


def instruction_record(r: Record) -> Rules:
    at, given = "instruction_meta", r.is_object("instruction_meta")
    said_false = lambda p: F.coalesce(~F.try_variant_get(r.v, f"$.{p}", "boolean"), F.lit(False))
    return [
        ("candidate_id or sample_id must be non-empty", r.text("candidate_id").isNull() & r.text("sample_id").isNull()),
        ("instruction must be non-empty", ~r.filled("instruction")), *r.an_object(at),
        (f"{at}.included_target_code must be false", given & ~said_false(f"{at}.included_target_code")),
        (f"{at}.included_intermediate_code must be false", given & r.there(f"{at}.included_intermediate_code") & (r.kind(f"{at}.included_intermediate_code") != "VOID") & ~said_false(f"{at}.included_intermediate_code")),
        (f"{at}.used_candidate or used_edit_record must be true", given & ~r.true(f"{at}.used_candidate") & ~r.true(f"{at}.used_edit_record")),
        (f"{at}.used_original_code must be true", given & ~r.true(f"{at}.used_original_code")),
        *[x for k in ("target_code", "intermediate_code", "original_code", "edit_record", "validation_report") for x in r.lacks(k, f"instruction record must not contain {k}")],
    ]


def final_record(r: Record) -> Rules:
    """A record with hidden fields; direct replacements need no appended block here, since they never have one."""
    at, given = "hidden.edit_record", r.is_object("hidden.edit_record")
    typed = r.text(f"{at}.edit_type")
    scaled = given & r.text(f"{at}.kind").isNotNull()
    named = given & r.text(f"{at}.kind").isNull() & typed.isNotNull()
    gone = named & (F.coalesce(r.text(f"{at}.candidate_type") == "structural_delete", F.lit(False)) | typed.startswith("delete_"))
    swapped = named & ~gone & (F.coalesce(r.text(f"{at}.candidate_type") == "structural_replace", F.lit(False)) | typed.startswith("replace_"))
    new = named & ~gone & ~swapped
    in_place = F.coalesce(typed.isin(*P.CUTOUT_REPLACE_TYPES, *P.FINISHING_REPLACE_TYPES), F.lit(False))
    lacking = lambda names, when: [(f"{at} missing {n}", when & ~r.there(f"{at}.{n}")) for n in names]
    count = F.size(F.try_variant_get(r.v, "$.images", "array<string>"))
    hidden = r.is_object("hidden")
    return [
        ("images must be a non-empty string list", ~r.strings("images", least=1)),
        ("images should contain exactly 3 paths", r.strings("images", least=1) & (count != 3)),
        ("instruction must be non-empty", ~r.filled("instruction")), *r.program("target_code"), *r.an_object("hidden"),
        ("hidden.original_code must be non-empty", hidden & ~r.filled("hidden.original_code")), (f"{at} must be an object", hidden & ~given),
        *lacking(PARAMETER[:6], scaled), *lacking(DELETION, gone), *lacking([x for x in REPLACEMENT if x != "instruction_template"], swapped), *lacking(ADDITION, new),
        (f"{at}.candidate_type must be structural_delete", gone & ~F.coalesce(r.text(f"{at}.candidate_type") == "structural_delete", F.lit(False))),
        (f"{at}.parameters must be an object", gone & ~r.is_object(f"{at}.parameters")),
        (f"{at}.candidate_type must be structural_replace", swapped & ~F.coalesce(r.text(f"{at}.candidate_type") == "structural_replace", F.lit(False))),
        *[(f"{at}.{x} must be an object", swapped & ~r.is_object(f"{at}.{x}")) for x in ("old_feature", "new_feature")],
        (f"{at}.insertion_strategy.append_csg_block must be true", ((swapped & ~in_place) | new) & ~r.true(f"{at}.insertion_strategy.append_csg_block")),
        (f"{at} must be either a V1 parameter edit or V2 structural edit", given & ~scaled & ~named),
        ("hidden.validation_report must be an object", hidden & ~r.is_object("hidden.validation_report")),
        ("hidden.validation_report.ok must be true", r.is_object("hidden.validation_report") & ~r.true("hidden.validation_report.ok")),
    ]


def training_record(r: Record) -> Rules:
    """Exactly the public fields, none of the hidden ones anywhere, and no detail in the instruction."""
    extra = F.array_except(F.coalesce(F.json_object_keys(F.col("raw")), F.array().cast("array<string>")), F.array(*[F.lit(x) for x in TRAINING_FIELDS]))
    return [
        ("training_extra_fields", F.size(extra) > 0),
        ("training_hidden_field_leak", F.size(forbidden_fields(F.col("raw"), HIDDEN_FIELDS)) > 0),
        ("training_missing_instruction", ~r.filled("instruction")),
        ("training_instruction_implementation_detail", r.filled("instruction") & F.coalesce(shows_code(r.text("instruction"), FINAL_CODE_WORDS), F.lit(False))),
        ("training_missing_target_code", ~r.filled("target_code")),
    ]


def chat_leaks(chats: DataFrame, records: DataFrame) -> DataFrame:
    """(sample_id, message) of ``chats`` (sample_id, messages: role and content) that show code or don't answer with the record's.

    ``records``: sample_id, target_code and original_code.
    """
    one = records.dropDuplicates(["sample_id"]).select("sample_id", "target_code", "original_code", F.lit(True).alias("known"))
    joined = chats.join(one, "sample_id", "left")
    asked, said = (F.try_element_at("messages", F.lit(i))["content"] for i in (2, 3))
    known, whole = F.col("known").isNotNull(), F.coalesce(F.size("messages") == 3, F.lit(False))
    has = lambda code: F.coalesce((code != "") & F.contains(asked, code), F.lit(False))
    ok = known & whole
    # The messages' names.
    rules = [
        ("unknown_sample_id", ~known), ("chat_sft_bad_messages", known & ~whole), ("chat_sft_missing_user_content", ok & asked.isNull()),
        ("chat_sft_user_contains_target_code", ok & has(F.col("target_code"))), ("chat_sft_user_contains_original_code", ok & has(F.col("original_code"))),
        ("chat_sft_user_code_leak", ok & F.coalesce(F.contains(asked, F.lit("CadQuery code:")) | F.contains(asked, F.lit("original_code")), F.lit(False))),
        ("chat_sft_assistant_not_exact_target_code", ok & ~F.coalesce(said == F.concat(F.lit("<code>"), "target_code", F.lit("</code>")), F.lit(False))),
    ]
    return joined.select("sample_id", F.explode(all_reasons(rules)).alias("message"))


CONTRACTS = {
    "candidates": parameter_candidate, "add_candidates": add_candidate, "delete_candidates": delete_candidate, "replace_candidates": replace_candidate,
    "validated_edits": validated_parameter, "validated_add_edits": validated_add, "validated_delete_edits": validated_delete,
    "validated_replace_edits": validated_replace, "instructions": instruction_record, "dataset": final_record, "training": training_record,
}
PROGRAMS = ("original_code", "intermediate_code", "target_code")


def verify(numbered: DataFrame, kind: str) -> DataFrame:
    """(source_line, message) for each rule of the contract ``kind`` that a line of ``numbered`` (source_line, raw) breaks."""
    rows = numbered.select("source_line", "raw").withColumn("record", F.try_parse_json("raw"))
    r = Record()
    rules = CONTRACTS[kind](r)
    if kind not in ("candidates", "add_candidates", "delete_candidates", "instructions", "training"):
        rows = rows.withColumns({f"parses_{p}": parses(r.text(p)) for p in PROGRAMS})
    shaped = F.coalesce(F.schema_of_variant("record").startswith("OBJECT"), F.lit(False))
    messages = F.when(~shaped, F.array(F.lit("expected a JSON object"))).otherwise(all_reasons(rules))
    return rows.select("source_line", F.explode(messages).alias("message"))
