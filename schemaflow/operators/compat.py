"""Compatibility of schema versions, for all pairs of a registry in one plan.

The unit of work is one pair of versions in one row. All rules are array expressions over the two parsed schemas of that
row, so that the only shuffle is the one which brings the two versions together.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schemaflow.functions.schema_docs import let, schema_doc, valid_doc

LEVELS = ("backward", "forward", "full", "none")

VIOLATION_TYPE = "struct<kind:string,field_name:string,old_value:string,new_value:string,message:string>"

# What a reader may promote besides reading the same type.
SAFE_PROMOTIONS = (
    "INT>LONG",
    "INT>FLOAT",
    "INT>DOUBLE",
    "LONG>FLOAT",
    "LONG>DOUBLE",
    "FLOAT>DOUBLE",
    "STRING>BYTES",
    "BYTES>STRING",
)
# The kinds of violations and their texts.
MESSAGES = {
    "MissingDefault": "field '%1$s' added without a default; old records would have nothing to fill it with",
    "RenamedWithoutAlias": (
        "field '%2$s' appears to have been renamed to '%3$s' but new schema has no aliases entry"
    ),
    "TypeIncompatible": "field '%1$s' type changed from '%2$s' to '%3$s' which is not a safe promotion",
    "RemovedRequiredField": "field '%1$s' was required in old schema and was removed without a default",
    "NonNullableMadeNullable": "field '%1$s' was non-nullable; making it nullable requires a default",
    "RecordNameMismatch": (
        "record full name changed from '%2$s' to '%3$s'; this is a different schema, not an evolution"
    ),
}
ROOT_FIELD = "<root>"
INVALID = "InvalidSchema"

# A 32-bit version splits into at most 2^15 blocks of at most 2^16 versions.
_BLOCK_BITS = 16


def parse_level(level: str) -> str:
    """Lower-case level name; anything unknown is an error."""
    if level.lower() not in LEVELS:
        raise ValueError(f"unknown compatibility level: {level.lower()}")
    return level.lower()


# ---- rules -------------------------------------------------------------------------------------------------------


def _violation(kind: str, field: Column, old: Column | None = None, new: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    old, new = (none if old is None else old), (none if new is None else new)
    return F.struct(
        F.lit(kind).alias("kind"),
        field.alias("field_name"),
        old.alias("old_value"),
        new.alias("new_value"),
        _text(MESSAGES[kind], field, old, new).alias("message"),
    )


def _text(pattern: str, *values: Column) -> Column:
    """``pattern`` with ``%1$s`` and so on replaced, null as "null", as format_string does, which reads the pattern again in every row."""
    pieces = re.split(r"%(\d)\$s", pattern)
    shown = [F.lit(x) if i % 2 == 0 else F.coalesce(values[int(x) - 1], F.lit("null")) for i, x in enumerate(pieces)]
    return F.concat(*shown)


def _nothing() -> Column:
    return F.array().cast(f"array<{VIOLATION_TYPE}>")


def _one_if(condition: Column, violation: Column) -> Column:
    return F.when(condition, F.array(violation)).otherwise(_nothing())


def _record_names(writer: Column, reader: Column) -> Column:
    renamed = (writer["full_name"] != reader["full_name"]) & ~F.array_contains(reader["aliases"], writer["full_name"])
    return _one_if(renamed, _violation("RecordNameMismatch", F.lit(ROOT_FIELD), writer["full_name"], reader["full_name"]))


def _source(writer: Column, field: Column) -> Column:
    """The writer field that a reader field reads: that of its name, else the first one its aliases list."""
    names = writer["names"]
    by_alias = F.get(F.filter(names, lambda n: F.array_contains(field["aliases"], n)), F.lit(0))
    known = F.when(F.array_contains(names, field["name"]), field["name"]).otherwise(by_alias)
    place = F.array_position(names, known) - 1
    return F.get(writer["fields"], place.cast("int"))


def _field_rules(field: Column, source: Column) -> Column:
    unfilled = ~field["has_default"] & ~field["is_nullable"]
    safe = (source["tag"] == field["tag"]) | F.concat(source["tag"], F.lit(">"), field["tag"]).isin(*SAFE_PROMOTIONS)
    opened = ~source["is_nullable"] & field["is_nullable"] & ~field["has_default"]
    retyped = _violation("TypeIncompatible", field["name"], source["tag"], field["tag"])
    loosened = _violation("NonNullableMadeNullable", field["name"])
    return (
        F.when(source.isNull(), _one_if(unfilled, _violation("MissingDefault", field["name"])))
        .when(safe, _one_if(opened, loosened))
        .when(opened, F.array(retyped, loosened))
        .otherwise(F.array(retyped))
    )


def _renames(writer: Column, reader: Column) -> Column:
    """Each writer-only field against the first reader-only field of its type."""
    reader_only = F.filter(
        reader["fields"],
        lambda f: ~F.array_contains(writer["names"], f["name"]) & ~F.arrays_overlap(f["aliases"], writer["names"]),
    )
    writer_only = F.filter(
        writer["fields"],
        lambda f: ~F.array_contains(reader["names"], f["name"])
        & ~F.array_contains(reader["field_aliases"], f["name"]),
    )

    def renamed(new: Column) -> Column:
        heirs = F.transform(
            writer_only,
            lambda f: F.struct(
                f["name"].alias("old"),
                F.get(new["names"], (F.array_position(new["tags"], f["tag"]) - 1).cast("int")).alias("new"),
            ),
        )
        return F.transform(
            F.filter(heirs, lambda h: h["new"].isNotNull()),
            lambda h: _violation("RenamedWithoutAlias", h["old"], h["old"], h["new"]),
        )

    return let(reader_only, lambda fields: let(_columns(fields), renamed))


def _columns(fields: Column) -> Column:
    names, tags = F.transform(fields, lambda f: f["name"]), F.transform(fields, lambda f: f["tag"])
    return F.struct(names.alias("names"), tags.alias("tags"))


def _one_way(writer: Column, reader: Column) -> list[Column]:
    """Arrays of violations, in rule order."""
    # No struct of both fields in between: a higher-order function copies what its body gives.
    rules = F.transform(reader["fields"], lambda f: let(_source(writer, f), lambda source: _field_rules(f, source)))
    # Each array that is put together costs more than a look at its size.
    by_field = F.flatten(F.filter(rules, lambda found: F.size(found) > 0))
    return [_record_names(writer, reader), by_field, _renames(writer, reader)]


def _removed_required(old: Column, new: Column) -> Column:
    """Old fields that are gone without a default and with no field of a new *name* and the same type to stand in.

    Unlike the rename rule this one looks at names only when it asks which new fields are new.
    """
    added = F.filter(new["fields"], lambda f: ~F.array_contains(old["names"], f["name"]))

    def removed(added: Column) -> Column:
        gone = F.filter(
            old["fields"],
            lambda f: ~F.array_contains(new["names"], f["name"])
            & ~F.array_contains(new["field_aliases"], f["name"])
            & ~f["has_default"]
            & ~F.array_contains(added["tags"], f["tag"]),
        )
        return F.transform(gone, lambda f: _violation("RemovedRequiredField", f["name"]))

    return let(added, lambda fields: let(_columns(fields), removed))


def violations(old: Column, new: Column, level: str) -> Column:
    """Array of violations between two ``schema_doc`` structs, without repeats and in rule order."""
    level = parse_level(level)
    if level == "none":
        return _nothing()

    def found(pair: Column) -> Column:
        old, new = pair["old"], pair["new"]
        parts = []
        if level in ("backward", "full"):
            parts.extend(_one_way(old, new))
        if level in ("forward", "full"):
            parts.extend(_one_way(new, old))
        if level in ("backward", "full"):
            parts.append(_removed_required(old, new))
        both_records = old["is_record"] & new["is_record"]
        return F.when(both_records, F.array_distinct(F.concat(*parts))).otherwise(_nothing())

    return let(F.struct(old.alias("old"), new.alias("new")), found)


def invalid(problem: Column) -> Column:
    """The one violation of a candidate that is no valid schema."""
    none = F.lit(None).cast("string")
    return F.array(
        F.struct(
            F.lit(INVALID).alias("kind"),
            F.lit(ROOT_FIELD).alias("field_name"),
            none.alias("old_value"),
            none.alias("new_value"),
            problem.alias("message"),
        )
    )


def report(found: Column) -> Column:
    """``compatible``, or one line for each violation."""
    lines = F.transform(
        found, lambda v: F.format_string("- **%s** (%s): %s", v["kind"], v["field_name"], v["message"])
    )
    return F.when(F.size(found) == 0, "compatible").otherwise(F.array_join(lines, "\n"))


# ---- pairs -------------------------------------------------------------------------------------------------------


def with_docs(registry: DataFrame) -> DataFrame:
    """subject, version and doc of each version, read once; a text that is no valid schema raises.

    A registry that comes with ``doc``, as :func:`schemaflow.sources.registry.read_registry` gives it, is not read again.
    """
    if "doc" in registry.columns:
        return registry.select("subject", "version", "doc")
    read = registry.select("subject", "version", schema_doc(F.col("schema")).alias("doc"))
    place = F.concat_ws(" version ", F.col("subject"), F.col("version").cast("string"))
    return read.withColumn("doc", valid_doc(F.col("doc"), place))


def schema_fields(registry: DataFrame) -> DataFrame:
    """The registry flattened to one row per field."""
    fields = with_docs(registry).select("subject", "version", F.posexplode_outer("doc.fields").alias("pos", "field"))
    return fields.filter(F.col("pos").isNotNull()).select("subject", "version", "pos", "field.*")


def consecutive_pairs(registry: DataFrame, value: str = "schema") -> DataFrame:
    """Every version of every subject next to the version that follows it, with ``value`` of both.

    A row without subject or version is in no pair.

    Windows run inside blocks of a subject's versions, and the first schema of each block is handed to the block before
    it, so no task holds more than 2^16 versions of a subject however many it has.
    """
    in_block = Window.partitionBy("subject", "block").orderBy("version")
    known = registry.filter(F.col("subject").isNotNull() & F.col("version").isNotNull())
    versions = known.select("subject", "version", value, F.shiftright("version", _BLOCK_BITS).alias("block"))
    next_version, next_value = F.lead("version").over(in_block), F.lead(value).over(in_block)
    following = versions.withColumns({"next_version": next_version, "next_value": next_value})
    # The same exchange serves both frames.
    heads = versions.withColumn("before", F.lag("version").over(in_block)).filter(F.col("before").isNull())
    by_block = Window.partitionBy("subject").orderBy("block")
    handed = heads.select(
        "subject",
        "block",
        F.lead("version").over(by_block).alias("head_version"),
        F.lead(value).over(by_block).alias("head_value"),
    ).filter(F.col("head_version").isNotNull())
    in_next_block = F.col("next_version").isNull()
    return (
        following.join(handed, ["subject", "block"], "left")
        .select(
            "subject",
            F.col("version").alias("old_version"),
            F.coalesce("next_version", "head_version").alias("new_version"),
            F.col(value).alias(f"old_{value}"),
            F.when(in_next_block, F.col("head_value")).otherwise(F.col("next_value")).alias(f"new_{value}"),
        )
        .filter(F.col("new_version").isNotNull())
    )


def chosen_pairs(registry: DataFrame, pairs: DataFrame, value: str = "schema") -> DataFrame:
    """``value`` of both versions of explicit ``(subject, old_version, new_version)`` rows."""
    old = registry.select("subject", F.col("version").alias("old_version"), F.col(value).alias(f"old_{value}"))
    new = registry.select("subject", F.col("version").alias("new_version"), F.col(value).alias(f"new_{value}"))
    return pairs.join(old, ["subject", "old_version"]).join(new, ["subject", "new_version"])


def check(pairs: DataFrame, level: str = "backward") -> DataFrame:
    """One row per pair with its ``violations``.

    Pairs hold schema texts, or the structs of :func:`with_docs`, which reads each version once however many pairs it is in.
    A text that is no valid schema raises.
    """
    if "old_schema" in pairs.columns:
        for side in ("old", "new"):
            pairs = pairs.withColumn(f"{side}_doc", schema_doc(F.col(f"{side}_schema"))).drop(f"{side}_schema")
            pairs = pairs.withColumn(f"{side}_doc", valid_doc(F.col(f"{side}_doc"), F.lit(f"the {side} version")))
    found = violations(F.col("old_doc"), F.col("new_doc"), level)
    return pairs.withColumn("violations", found).drop("old_doc", "new_doc")


def check_consecutive(registry: DataFrame, level: str = "backward") -> DataFrame:
    """Every version of every subject against the one before it."""
    return check(consecutive_pairs(with_docs(registry), "doc"), level)


def violation_rows(checked: DataFrame, level: str = "backward") -> DataFrame:
    """One row per violation; ``ord`` counts from 1 within a pair.

    The outer form of explode keeps the optimizer from filtering on the array first, which would compute it twice.
    """
    keys = [c for c in checked.columns if c != "violations"]
    rows = checked.select(*keys, F.posexplode_outer("violations").alias("ord", "v")).filter(F.col("ord").isNotNull())
    return rows.select(*keys, F.lit(level).alias("level"), (F.col("ord") + 1).alias("ord"), "v.*")


def reports(checked: DataFrame) -> DataFrame:
    """One row per pair with the verdict, the report text and the exit status of a check: 0 or 1."""
    keys = [c for c in checked.columns if c != "violations"]
    return checked.select(
        *keys,
        (F.size("violations") == 0).alias("compatible"),
        report(F.col("violations")).alias("report"),
        F.when(F.size("violations") == 0, 0).otherwise(1).alias("status"),
    )
