"""Reading payloads of one definition as another: a test for each rule, and what goes wrong where a rule is broken."""

import itertools
import json

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import avro
from millrace.functions.resolution import Resolution, Unresolvable
from millrace.operators import registry


def record(*fields, name="R", **more):
    return {"type": "record", "name": name, "fields": [{"name": f[0], "type": f[1], **(f[2] if len(f) > 2 else {})} for f in fields], **more}


def plain(v):
    if isinstance(v, Row):
        return {k: plain(x) for k, x in v.asDict().items()}
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    if isinstance(v, dict):
        return {k: plain(x) for k, x in v.items()}
    return bytes(v) if isinstance(v, bytearray) else v


def read(spark, writer, reader, *payloads):
    """(value, error) of each payload; a payload that is no text is written as JSON."""
    texts = [(n, p if p is None or isinstance(p, str) else json.dumps(p)) for n, p in enumerate(payloads)]
    how = Resolution(None if writer is None else avro.normal_form(writer), avro.normal_form(reader, aliases=True))
    df = spark.createDataFrame(texts, "n int, value string").withColumn("x", F.try_parse_json("value"))
    got = df.select("n", F.when(how.error(F.col("x")).isNull(), how.value(F.col("x"))).alias("v"), how.error(F.col("x")).alias("e")).orderBy("n").collect()
    return [(plain(r["v"]), r["e"]) for r in got]


def values(spark, writer, reader, *payloads):
    """The same of a single field x."""
    got = read(spark, record(("x", writer)), record(("x", reader)), *({"x": p} for p in payloads))
    return [v["x"] if e is None else e for v, e in got]


GOOD = {"null": [None], "boolean": [True, False], "int": [0, -2**31, 2**31 - 1], "long": [2**63 - 1, -5], "float": [1, 0.5, 1e3], "double": [1e300, 2, -0.25],
        "string": ["", "5", "é"], "bytes": ["", "ÿ\u0000"]}
WIDER = {("int", "long"), ("int", "float"), ("int", "double"), ("long", "float"), ("long", "double"), ("float", "double"), ("string", "bytes"), ("bytes", "string")}


def test_primitives_and_promotions(spark):
    for w, r in itertools.product(GOOD, GOOD):
        if w == r or (w, r) in WIDER:
            samples = ["", "abc"] if {w, r} == {"string", "bytes"} else GOOD[w]
            got = values(spark, w, r, *samples)
            as_read = {"bytes": lambda s: s.encode("latin-1"), "float": lambda s: float(np.float32(s)), "double": float}.get(r, lambda s: s)
            assert got == [as_read(s) for s in samples], (w, r)
        else:
            with pytest.raises(Unresolvable, match=f"field x: {w} is no {r}"):
                values(spark, w, r, None)


@pytest.mark.parametrize("kind, wrong", [
    ("null", [0, "", {}]), ("boolean", [1, "true", None]), ("int", ["5", 1.5, 2**31, True, None, [1], {}]), ("long", [2**63, "1", 1e3]),
    ("float", ["1.5", True]), ("double", ["NaN", None]), ("string", [5, True, None, ["a"], {}]), ("bytes", ["Ā", 3]),
    ({"type": "array", "items": "int"}, [5, {"0": 1}, "[1]"]), ({"type": "map", "values": "int"}, [[1], 5]),
    ({"type": "fixed", "name": "F", "size": 2}, ["a", "abc", 12]), ({"type": "enum", "name": "E", "symbols": ["A"]}, ["B", 1, "a"])])
def test_wrong_types_have_an_error(spark, kind, wrong):
    assert values(spark, kind, kind, *wrong) == ["WrongType: x"] * len(wrong)


def test_malformed_and_missing(spark):
    r = record(("x", "int"), ("y", ["null", "int"]), ("z", record(("a", "string"), name="Z")))
    got = read(spark, r, r, '{"x":', "", "null", "[1]", "7", {}, {"x": 1}, {"x": 1, "z": {}}, {"x": 1, "z": {"a": 3}}, {"x": 1, "z": {"a": "b"}}, '{"x":1,"x":2}')
    assert [e for _, e in got] == ["MalformedPayload", "MalformedPayload", "WrongType", "WrongType", "WrongType", "MissingField: x", "MissingField: z",
                                   "MissingField: z.a", "WrongType: z.a", None, "MalformedPayload"]
    assert got[9][0] == {"x": 1, "y": None, "z": {"a": "b"}}


def test_fields_by_name_alias_and_default(spark):
    writer = record(("old", "int"), ("gone", "string"), ("both", "int"), ("alias_of_both", "int"))
    reader = record(("new", "long", {"aliases": ["never", "old"]}), ("both", "int", {"aliases": ["alias_of_both"]}), ("lost", "int", {"default": 9}),
                    ("n", ["null", "string"], {"default": None}), ("m", ["string", "null"], {"default": "d"}))
    payload = {"old": 3, "gone": "x", "both": 1, "alias_of_both": 2}
    assert read(spark, writer, reader, payload) == [({"new": 3, "both": 1, "lost": 9, "n": None, "m": "d"}, None)]
    # What the reader drops must still be what the writer's definition says.
    assert read(spark, writer, reader, {**payload, "gone": 5}) == [(None, "WrongType: gone")]
    with pytest.raises(Unresolvable, match="field new has no default"):
        Resolution(avro.normal_form(record(("x", "int"))), avro.normal_form(record(("new", "int"))))


def test_names_of_records(spark):
    one, two = avro.normal_form(record(("x", "int"), name="A", namespace="p")), lambda **k: avro.normal_form(record(("x", "int"), **k), aliases=True)
    assert Resolution(one, two(name="A", namespace="q")) and Resolution(one, two(name="B", namespace="p", aliases=["A"])) and Resolution(one, two(name="B", aliases=["p.A"]))
    with pytest.raises(Unresolvable, match="p.A is no p.B"):
        Resolution(one, two(name="B", namespace="p"))


@pytest.mark.parametrize("form, default, expected", [
    ("bytes", "ÿ\u0001", b"\xff\x01"), ("double", 1, 1.0), ({"type": "array", "items": "long"}, [1, 2], [1, 2]), ({"type": "array", "items": "long"}, [], []),
    ({"type": "map", "values": "long"}, {"a": 1}, {"a": 1}), ({"type": "map", "values": "int"}, {}, {}), ({"type": "enum", "name": "E", "symbols": ["A", "B"]}, "B", "B"),
    (record(("a", "int", {"default": 4}), ("b", "string"), name="N"), {"b": "q"}, {"a": 4, "b": "q"}),
    (["int", "string"], 7, {"member0": 7, "member1": None}), (["null", {"type": "array", "items": ["null", "int"]}], None, None)])
def test_defaults_of_every_type(spark, form, default, expected):
    got = read(spark, record(("x", "int")), record(("x", "int"), ("d", form, {"default": default})), {"x": 1})
    assert got == [({"x": 1, "d": expected}, None)]


def test_enumerations(spark):
    writer = {"type": "enum", "name": "E", "symbols": ["A", "B", "C"]}
    assert values(spark, writer, {**writer, "symbols": ["C", "A"]}, "A", "B", "D") == ["A", "UnknownSymbol: x", "WrongType: x"]
    assert values(spark, writer, {**writer, "symbols": ["C", "A"], "default": "C"}, "A", "B", "D") == ["A", "C", "WrongType: x"]


def test_arrays_and_maps_go_deep(spark):
    def items(kind, *more):
        return {"type": "array", "items": {"type": "map", "values": record(("n", kind), *more, name="N")}}

    got = values(spark, items("int"), items("double", ("d", "string", {"default": "?"})), [{"a": {"n": 1}}, {}, {"b": {"n": 2}, "c": {"n": 3}}], [],
                 [{"a": {"n": 1}}, {"b": {"n": "x"}}], [{"a": {}}], [[1]], [None])
    n = lambda x: {"n": x, "d": "?"}
    assert got == [[{"a": n(1.0)}, {}, {"b": n(2.0), "c": n(3.0)}], [], "WrongType: x[][].n", "MissingField: x[][].n", "WrongType: x[]", "WrongType: x[]"]


def test_unions(spark):
    point = record(("x", "int"), name="Point")
    many = ["null", "int", "string", point, {"type": "array", "items": "int"}]
    m = lambda n, v: {f"member{k}": v if k == n else None for k in range(4)}
    payloads = [None, 5, "s", {"x": 1}, [1], {"int": 5}, {"string": "s"}, {"Point": {"x": 2}}, {"array": [3]}, 1.5, {"x": "no"}, {"long": 5}]
    expected = [None, m(0, 5), m(1, "s"), m(2, {"x": 1}), m(3, [1]), m(0, 5), m(1, "s"), m(2, {"x": 2}), m(3, [3])] + ["WrongType: x"] * 3
    assert values(spark, many, many, *payloads) == expected
    # A union read as one type: branches that cannot be read are errors of their rows.
    assert values(spark, ["null", "int", "string"], "long", 5, None, "s") == [5, "UnresolvableSchema: x", "UnresolvableSchema: x"]
    # One type read as a union: the branch of the same type, else the first that can be.
    assert values(spark, "int", ["null", "double", "int"], 5) == [{"member0": None, "member1": 5}]
    assert values(spark, "int", ["string", "double", "null"], 5) == [{"member0": None, "member1": 5.0}]
    assert values(spark, ["null", "int"], ["null", "long"], 5, None, {"int": 6}, "x") == [5, None, 6, "WrongType: x"]
    with pytest.raises(Unresolvable, match="no branch for boolean"):
        values(spark, "boolean", ["null", "string"], True)
    # A map with the branch's name as its key is a map.
    assert values(spark, ["null", {"type": "map", "values": "int"}], ["null", {"type": "map", "values": "int"}], {"map": 1}, {"map": {"a": 1}}) == [{"map": 1}, {"a": 1}]


def test_named_types_are_looked_up(spark):
    place = record(("city", "string"), name="Place")
    r = record(("a", place), ("b", "Place"), ("c", ["null", "Place"]))
    assert read(spark, r, r, {"a": {"city": "u"}, "b": {"city": "v"}, "c": {"city": "w"}}) == [({"a": {"city": "u"}, "b": {"city": "v"}, "c": {"city": "w"}}, None)]
    tree = record(("left", ["null", "Tree"]), name="Tree")
    with pytest.raises(ValueError, match="recursive type"):
        Resolution(avro.normal_form(tree), avro.normal_form(tree))


def test_own_payloads_may_lack_fields_with_defaults(spark):
    r = record(("x", "int"), ("d", "int", {"default": 3}), ("p", record(("q", "int", {"default": 4}), name="P"), {"default": {}}))
    got = read(spark, None, r, {"x": 1}, {"x": 1, "d": "no"}, {"x": 1, "d": 2, "p": {}}, {})
    assert got == [({"x": 1, "d": 3, "p": {"q": 4}}, None), (None, "WrongType: d"), ({"x": 1, "d": 2, "p": {"q": 4}}, None), (None, "MissingField: x")]


# --- the operator

V1 = record(("x", "int"), ("c", "string", {"default": "d"}))
V2 = record(("y", "int"))
OTHER = record(("x", "int"), name="Another")


def stored_definitions(spark, *definitions):
    asked = spark.createDataFrame([("s", "avro", json.dumps(d), n) for n, d in enumerate(definitions)], "subject string, format string, definition string, arrival long")
    return registry.register(registry.empty_store(spark), asked)


def rows_of(spark, *rows):
    return spark.createDataFrame([(n, p, {"contentType": f"application/vnd.s.v{v}+avro"} if v else {}) for n, (v, p) in enumerate(rows)],
                                 "offset int, value string, headers map<string,string>")


def test_resolve_errors_and_tombstones(spark):
    store = stored_definitions(spark, V1, V2, OTHER)
    reader = json.dumps(record(("x", "long", {"aliases": ["y"]}), ("c", "string", {"default": "d"})))
    rows = rows_of(spark, (1, '{"x":'), (1, None), (1, '{"x":"oops","c":"e"}'), (1, "{}"), (1, '{"x":1,"c":"e"}'), (2, '{"y":7}'), (3, '{"x":1}'), (9, '{"x":1}'),
                   (9, None), (None, '{"x":5}'), (None, '{"c":"e"}'))
    got = [(plain(r["data"]), r["error"]) for r in registry.resolve(rows, store, reader).orderBy("offset").collect()]
    assert got == [(None, "MalformedPayload"), (None, None), (None, "WrongType: x"), (None, "MissingField: x"), ({"x": 1, "c": "e"}, None), ({"x": 7, "c": "d"}, None),
                   (None, "UnresolvableSchema: Another is no R"), (None, "UnknownSchemaVersion"), (None, None), ({"x": 5, "c": "d"}, None), (None, "MissingField: x")]
    # An error's rows can be filtered without changing them.
    read = registry.resolve(rows, store, reader)
    assert read.where("error is null").count() == 5 and read.where("data.x = 7").count() == 1


def test_resolve_as_a_spark_type(spark):
    store = stored_definitions(spark, V1, record(("x", "int"), ("when", "string"), ("amount", "string"), ("in", record(("k", "int"), name="K"))))
    kind = T.StructType.fromDDL("x long, c string, amount decimal(9,2), when date, in struct<k:double, l:string>, tags array<string>, m map<string,int>")
    rows = rows_of(spark, (1, '{"x":1,"c":"e"}'), (2, '{"x":2,"when":"2024-02-29","amount":"1.25","in":{"k":3}}'), (None, "{}"), (None, '{"tags":["a",null],"m":{"a":1}}'))
    got = registry.resolve(rows, store, kind, {"c": "dflt", "tags": ["t"]}).orderBy("offset")
    assert got.schema["data"].dataType.simpleString() == kind.simpleString()
    assert [r["error"] for r in got.collect()] == [None] * 4
    assert [str(tuple(r["data"])) for r in got.collect()] == [
        "(1, 'e', None, None, None, ['t'], None)",
        "(2, 'dflt', Decimal('1.25'), datetime.date(2024, 2, 29), Row(k=3.0, l=None), ['t'], None)",
        "(None, 'dflt', None, None, None, ['t'], None)", "(None, 'dflt', None, None, None, ['a', None], {'a': 1})"]


def test_resolve_refuses_plans_without_bound(spark, monkeypatch):
    store = stored_definitions(spark, V1, V2, OTHER)
    monkeypatch.setattr(registry, "MAX_PLANS", 2)
    rows = rows_of(spark, (1, '{"x":1,"c":"e"}'))
    with pytest.raises(ValueError, match="name the subjects"):
        registry.resolve(rows, store, json.dumps(V1))
    assert registry.resolve(rows, store, json.dumps(V1), subjects=["t"]).first()["error"] == "UnknownSchemaVersion"


def test_a_payload_is_parsed_once(spark):
    read = registry.resolve(rows_of(spark, (1, "{}")), stored_definitions(spark, V1, V2), json.dumps(V1)).where("error is null and data.x > 3")
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") == 1
