from __future__ import annotations

import json
import random

import pytest
import rules_oracle
from conftest import plan_of

from schemaflow.functions.schema_docs import SchemaReader, read_doc
from schemaflow.operators import compat
from schemaflow.schemas import ORDER_V1, ORDER_V2, ORDER_V3

NULLABLE = ["null", "long"]
MD, RN, TI = "MissingDefault", "RenamedWithoutAlias", "TypeIncompatible"
RR, NN, NM = "RemovedRequiredField", "NonNullableMadeNullable", "RecordNameMismatch"


def f(name, kind="long", **more):
    return {"name": name, "type": kind, **more}


def rec(*fields, name="R", **more):
    return json.dumps({"type": "record", "name": name, "namespace": "x", "fields": list(fields), **more})


ID, AMOUNT = f("id", "string"), f("amount")
BASE = rec(ID, AMOUNT)

# old, new, then the violations under backward, forward and full.
CASES = {
    "add_default": (BASE, rec(ID, AMOUNT, f("d", default=0)), [], [], []),
    "add_nullable_null": (BASE, rec(ID, AMOUNT, f("d", NULLABLE, default=None)), [], [], []),
    "add_nullable_bare": (BASE, rec(ID, AMOUNT, f("d", NULLABLE)), [], [], []),
    "add_required": (BASE, rec(ID, AMOUNT, f("d")), [(MD, "d")], [], [(MD, "d")]),
    "remove_defaulted": (rec(ID, f("d", default=0)), rec(ID), [], [], []),
    "remove_required": (BASE, rec(ID), [(RR, "amount")], [(MD, "amount")], [(MD, "amount"), (RR, "amount")]),
    "rename": (
        BASE,
        rec(ID, f("total")),
        [(MD, "total"), (RN, "amount", "total")],
        [(MD, "amount"), (RN, "total", "amount")],
        [(MD, "total"), (RN, "amount", "total"), (MD, "amount"), (RN, "total", "amount")],
    ),
    "rename_alias": (
        BASE,
        rec(ID, f("total", aliases=["amount"])),
        [],
        [(MD, "amount"), (RN, "total", "amount")],
        [(MD, "amount"), (RN, "total", "amount")],
    ),
    "widen": (rec(f("n", "int")), rec(f("n")), [], [(TI, "n", "LONG", "INT")], [(TI, "n", "LONG", "INT")]),
    "narrow": (rec(f("n")), rec(f("n", "int")), [(TI, "n", "LONG", "INT")], [], [(TI, "n", "LONG", "INT")]),
    "retype": (
        rec(f("n", "int")),
        rec(f("n", "string")),
        [(TI, "n", "INT", "STRING")],
        [(TI, "n", "STRING", "INT")],
        [(TI, "n", "INT", "STRING"), (TI, "n", "STRING", "INT")],
    ),
    "text_to_bytes": (rec(f("n", "string")), rec(f("n", "bytes")), [], [], []),
    "open_bare": (rec(f("a")), rec(f("a", NULLABLE)), [(NN, "a")], [], [(NN, "a")]),
    "open_default": (rec(f("a")), rec(f("a", NULLABLE, default=None)), [], [], []),
    "close": (rec(f("a", NULLABLE)), rec(f("a")), [], [(NN, "a")], [(NN, "a")]),
    "record_renamed": (
        rec(ID, name="A"),
        rec(ID, name="B"),
        [(NM, "x.A", "x.B")],
        [(NM, "x.B", "x.A")],
        [(NM, "x.A", "x.B"), (NM, "x.B", "x.A")],
    ),
    "record_alias": (
        rec(ID, name="A"),
        rec(ID, name="B", aliases=["x.A"]),
        [],
        [(NM, "x.B", "x.A")],
        [(NM, "x.B", "x.A")],
    ),
    "record_alias_short": (rec(ID, name="A"), rec(ID, name="B", aliases=["A"]), [], [(NM, "x.B", "x.A")], [(NM, "x.B", "x.A")]),
    "one_heir_for_two": (
        rec(f("a"), f("b")),
        rec(f("c", "string"), f("d")),
        [(MD, "c"), (MD, "d"), (RN, "a", "d"), (RN, "b", "d")],
        [(MD, "a"), (MD, "b"), (RN, "d", "a")],
        [(MD, "c"), (MD, "d"), (RN, "a", "d"), (RN, "b", "d"), (MD, "a"), (MD, "b"), (RN, "d", "a")],
    ),
    "alias_hides_removal": (
        rec(f("a"), f("b")),
        rec(f("c", aliases=["a"])),
        [],
        [(MD, "a"), (MD, "b"), (RN, "c", "a")],
        [(MD, "a"), (MD, "b"), (RN, "c", "a")],
    ),
    "orders_1_2": (ORDER_V1, ORDER_V2, [], [], []),
    "orders_2_3": (
        ORDER_V2,
        ORDER_V3,
        [(MD, "total_amount_cents"), (RN, "total_cents", "total_amount_cents")],
        [(MD, "total_cents"), (RN, "total_amount_cents", "total_cents")],
        [
            (MD, "total_amount_cents"),
            (RN, "total_cents", "total_amount_cents"),
            (MD, "total_cents"),
            (RN, "total_amount_cents", "total_cents"),
        ],
    ),
    "not_records": ('"string"', '["null","string"]', [], [], []),
    "record_to_enum": (BASE, json.dumps({"type": "enum", "name": "E", "symbols": ["A"]}), [], [], []),
    "same_tag_inside": (
        rec(f("a", {"type": "array", "items": "int"}), f("e", {"type": "enum", "name": "E", "symbols": ["A"]})),
        rec(f("a", {"type": "array", "items": "string"}), f("e", {"type": "enum", "name": "G", "symbols": ["B"]})),
        [],
        [],
        [],
    ),
    "wide_union": (
        rec(f("a", ["null", "int", "string"])),
        rec(f("a", ["int", "string"])),
        [],
        [(NN, "a")],
        [(NN, "a")],
    ),
}


def brief(v):
    if v["kind"] in (RN, NM):
        return (v["kind"], v["old_value"], v["new_value"])
    if v["kind"] == TI:
        return (TI, v["field_name"], v["old_value"], v["new_value"])
    return (v["kind"], v["field_name"])


def pairs_frame(spark, pairs):
    rows = [(name, 1, 2, old, new) for name, (old, new) in pairs.items()]
    return spark.createDataFrame(
        rows, "subject string, old_version int, new_version int, old_schema string, new_schema string"
    )


@pytest.fixture(scope="module")
def outcomes(spark):
    frame = pairs_frame(spark, {n: c[:2] for n, c in CASES.items()})
    return {
        level: {r["subject"]: [brief(v) for v in r["violations"]] for r in compat.check(frame, level).collect()}
        for level in compat.LEVELS
    }


@pytest.mark.parametrize("case", CASES)
def test_cases(outcomes, case):
    _, _, backward, forward, full = CASES[case]
    assert outcomes["backward"][case] == backward
    assert outcomes["forward"][case] == forward
    assert outcomes["full"][case] == full
    assert outcomes["none"][case] == []


def test_levels():
    assert compat.parse_level("BackWard") == "backward"
    with pytest.raises(ValueError, match="unknown compatibility level: sideways"):
        compat.parse_level("Sideways")


def test_report(spark):
    frame = pairs_frame(spark, {"bad": (ORDER_V2, ORDER_V3), "good": (ORDER_V1, ORDER_V2)})
    rows = {r["subject"]: r for r in compat.reports(compat.check(frame, "backward")).collect()}
    assert (rows["good"]["report"], rows["good"]["status"], rows["good"]["compatible"]) == ("compatible", 0, True)
    assert rows["bad"]["status"] == 1
    assert rows["bad"]["report"] == (
        "- **MissingDefault** (total_amount_cents): field 'total_amount_cents' added without a default; "
        "old records would have nothing to fill it with\n"
        "- **RenamedWithoutAlias** (total_cents): field 'total_cents' appears to have been renamed to "
        "'total_amount_cents' but new schema has no aliases entry"
    )


def test_messages(spark):
    frame = pairs_frame(spark, {n: CASES[n][:2] for n in ("narrow", "remove_required", "open_bare", "record_renamed")})
    rows = compat.violation_rows(compat.check(frame, "backward")).collect()
    assert {r["kind"]: r["message"] for r in rows} == {
        TI: "field 'n' type changed from 'LONG' to 'INT' which is not a safe promotion",
        RR: "field 'amount' was required in old schema and was removed without a default",
        NN: "field 'a' was non-nullable; making it nullable requires a default",
        NM: "record full name changed from 'x.A' to 'x.B'; this is a different schema, not an evolution",
    }
    assert all(r["ord"] == 1 and r["level"] == "backward" for r in rows)


@pytest.mark.parametrize("text", ['{"type": ', "hello, not a schema", rec(f("a", "strnig")), "{}"])
def test_malformed_schema_raises(spark, text):
    with pytest.raises(Exception, match="malformed schema of the old version"):
        compat.check(pairs_frame(spark, {"broken": (text, BASE)})).collect()
    rows = spark.createDataFrame([("s", 3, text)], "subject string, version int, schema string")
    with pytest.raises(Exception, match="malformed schema of s version 3"):
        sound = spark.createDataFrame([("s", 4, BASE)], "subject string, version int, schema string")
        compat.check_consecutive(rows.unionByName(sound)).collect()


ENUM, FIXED = {"type": "enum", "name": "E", "symbols": ["A"]}, {"type": "fixed", "name": "F", "size": 2}
INVALID = {
    "not json": "the text is not JSON",
    '{"type":"int","x":NaN}': "the text is not JSON",
    rec(f("a", "strnig")): "unknown type name strnig",
    rec(f("a", "E"), f("b", ENUM)): "unknown type name E",
    rec(f("a", ENUM), f("b", ENUM)): "type name x.E defined twice",
    '{"type":"record","name":"R"}': "no fields",
    '{"type":"record","fields":[]}': "no name",
    '{"type":"record","name":"R","fields":{}}': "no list of fields",
    rec(f("a"), f("a")): "field a twice",
    rec(f("a b")): "without a valid name",
    rec({"name": "a"}): "no type",
    rec(f("a", default="text")): "default that does not fit",
    rec(f("a", "int", default=2**40)): "default that does not fit",
    rec(f("a", ["null", "long"], default="x")): "default that does not fit",
    rec(f("a", {**ENUM, "symbols": []}, default="A")): "default that does not fit",
    rec(f("a", {**ENUM, "symbols": ["A", "A"]})): "symbol twice",
    rec(f("a", {"type": "enum", "name": "E"})): "no symbols",
    rec(f("a", {"type": "fixed", "name": "F"})): "no size",
    rec(f("a", {"type": "array"})): "no items",
    rec(f("a", {"type": "map"})): "no values",
    rec(f("a", [["int"]])): "union directly inside",
    rec(f("a", ["int", "int"])): "type twice",
    rec(f("a", aliases="b")): "aliases",
    "[1]": "no type",
    "5": "no type",
}
VALID = [
    '"string"', '["null","string"]', json.dumps(ENUM), rec(), rec(f("a", ["null", "R"])), rec(f("a", FIXED), f("b", "x.F")),
    rec(f("a", ENUM, default="A")), rec(f("a", {"type": "map", "values": ["null", "E0"]}), name="E0"),
    rec(f("a", {"type": "record", "name": "Q", "fields": [f("y", "int", default=1)]}, default={})),
]


@pytest.mark.parametrize("text", INVALID)
def test_invalid_texts_have_a_problem(text):
    doc = read_doc(text)
    assert INVALID[text] in doc["problem"] and not doc["fields"] and not doc["is_record"]


@pytest.mark.parametrize("text", VALID)
def test_valid_texts_have_none(text):
    assert read_doc(text)["problem"] is None


def test_equal_last_parts_are_different_types(spark):
    text = rec(
        f("a", {"type": "enum", "namespace": "p", "name": "T", "symbols": ["A"]}),
        f("b", {"size": 1, "type": "fixed", "name": "q.T"}),
        f("c", "p.T"),
        f("d", ["null", "q.T"]),
        f("e", {"type": {"type": {"type": "p.T"}}}),
    )
    tags = {d["name"]: (d["tag"], d["is_nullable"]) for d in read_doc(text)["fields"]}
    assert tags == {
        "a": ("ENUM", False), "b": ("FIXED", False), "c": ("ENUM", False), "d": ("FIXED", True), "e": ("ENUM", False)
    }


def test_references_take_the_kind_they_name(spark):
    text = rec(
        f("a", {"type": "enum", "name": "E", "symbols": ["A"]}),
        f("b", ["null", "E"]),
        f("c", {"name": "F", "size": 2, "type": "fixed"}),
        f("d", "x.F"),
        f("e", ["null", "R"]),
    )
    frame = spark.createDataFrame([("s", 1, text)], "subject string, version int, schema string")
    tags = {r["name"]: (r["tag"], r["is_nullable"]) for r in compat.schema_fields(frame).collect()}
    assert tags == {
        "a": ("ENUM", False),
        "b": ("ENUM", True),
        "c": ("FIXED", False),
        "d": ("FIXED", False),
        "e": ("RECORD", True),
    }


def test_consecutive_pairs_follow_version_numbers(spark):
    far = 3 << 16
    numbers = [1, 2, 10, 9, far, far + 5, 70000]
    rows = [("s", n, f"t{n}") for n in numbers] + [("other", 4, "o4")]
    frame = spark.createDataFrame(rows, "subject string, version int, schema string")
    got = compat.consecutive_pairs(frame).orderBy("old_version").collect()
    want = sorted(numbers)
    assert [(r["old_version"], r["new_version"]) for r in got] == list(zip(want, want[1:]))
    assert all(r["old_schema"] == f"t{r['old_version']}" and r["new_schema"] == f"t{r['new_version']}" for r in got)


def test_plan_reads_each_schema_once_and_has_no_cross_join(spark):
    frame = spark.range(10).selectExpr("'s' subject", "cast(id as int) version", "cast(id as string) schema")
    plan = plan_of(compat.check_consecutive(frame))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(compat.check_consecutive(frame))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("ArrowEvalPython") == 1 and "ReusedExchange" in plan, plan


PRIMITIVES = ["string", "int", "long", "float", "double", "boolean", "bytes"]


DEFAULTS = {"string": "", "bytes": "", "boolean": False, "float": 0.5, "double": 1, "int": 0, "long": 0, "map": {}}


def fitting_default(kind):
    if isinstance(kind, list):
        return None
    return DEFAULTS[kind if isinstance(kind, str) else kind["type"]]


def random_field(rng, name):
    plain = rng.choice(PRIMITIVES)
    odd = [
        ["null", "int", "string"],
        {"type": "long", "logicalType": "timestamp-millis"},
        {"type": "map", "values": "int"},
    ]
    made = {"name": name, "type": rng.choice([plain, plain, plain, ["null", plain], [plain, "null"], rng.choice(odd)])}
    if rng.random() < 0.5:
        made["default"] = fitting_default(made["type"])
    if rng.random() < 0.25:
        made["aliases"] = rng.sample(["aa", "bb", "cc", "dd", "ee", "ff"], rng.randint(0, 2))
    return made


def random_definition(rng, names):
    """A named type with its keys in any order and braces in its doc."""
    name = names.pop()
    kind = rng.choice(["enum", "fixed", "record"])
    body = {"enum": {"symbols": ["A"]}, "fixed": {"size": 2}, "record": {"fields": [{"name": "x", "type": "int"}]}}[kind]
    made = {"type": kind, "name": name, "doc": 'one of {x} or ["type"', **body}
    if rng.random() < 0.5:
        made["namespace"] = rng.choice(["p", "q"])
    return dict(rng.sample(list(made.items()), len(made)))


def random_schema(rng):
    chosen = rng.sample(["aa", "bb", "cc", "dd", "ee", "ff"], rng.randint(0, 5))
    doc = {"type": "record", "name": rng.choice("RS"), "fields": [random_field(rng, n) for n in chosen]}
    if rng.random() < 0.5:
        doc["namespace"] = rng.choice(["x", "y.z"])
    names, known = rng.sample(["T", "U", "V", "W"], 4), []
    for field in doc["fields"]:
        draw = rng.random()
        if draw < 0.25 and names:
            made = random_definition(rng, names)
            space = made.get("namespace", doc.get("namespace", ""))
            known.append(f"{space}.{made['name']}" if space else made["name"])
            field["type"] = {"type": {"type": made}} if draw < 0.05 else made
        elif draw < 0.6 and known:
            full = rng.choice(known)
            space, _, short = full.rpartition(".")
            named = short if space == doc.get("namespace", "") else full
            field["type"] = rng.choice([named, ["null", named]])
        else:
            continue
        field.pop("default", None)
    if rng.random() < 0.3:
        doc["aliases"] = rng.sample(["R", "S", "x.R", "y.z.S"], rng.randint(0, 2))
    return json.dumps(doc)


@pytest.mark.parametrize("level", ["backward", "forward", "full"])
def test_random_pairs_equal_the_plain_rules(spark, level):
    rng = random.Random(level)
    named = {f"p{i}": (random_schema(rng), random_schema(rng)) for i in range(800)}
    for row in compat.check(pairs_frame(spark, named).repartition(8), level).collect():
        got = [(v["kind"], v["field_name"], v["old_value"], v["new_value"]) for v in row["violations"]]
        assert got == rules_oracle.check(*named[row["subject"]], level), named[row["subject"]]


def test_fields_of_a_text_are_read_once(monkeypatch):
    read, calls = SchemaReader.fields, []
    monkeypatch.setattr(SchemaReader, "fields", lambda self, *args: calls.append(args[1]) or read(self, *args))
    doc = read_doc(rec(f("a", aliases=["b"]), f("c", ["null", "int"], default=None)))
    assert calls == [doc["full_name"]]
    assert doc["names"] == ["a", "c"] and doc["field_aliases"] == ["b"]
    assert [x["is_nullable"] for x in doc["fields"]] == [False, True]


def test_a_field_can_break_two_rules(spark):
    """Both violations of one field, in rule order, with the texts that format_string gave."""
    old, new = rec(f("a", "string")), rec(f("a", ["null", "int"]))
    rows = compat.check(pairs_frame(spark, {"one": (old, new)}), "backward").collect()
    found = [(v["kind"], v["message"]) for v in rows[0]["violations"]]
    assert found == [
        ("TypeIncompatible", "field 'a' type changed from 'STRING' to 'INT' which is not a safe promotion"),
        ("NonNullableMadeNullable", "field 'a' was non-nullable; making it nullable requires a default"),
    ]
