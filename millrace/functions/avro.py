"""Checking and normalising Avro definitions, which are JSON texts.

Used on distinct definitions only; rows of data never pass through here."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the Avro specification.
PRIMITIVES = {"null", "boolean", "int", "long", "float", "double", "bytes", "string"}
NAMED = {"record", "error", "enum", "fixed"}
_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _full_name(name: str, namespace: str | None) -> str:
    full = name if "." in name or not namespace else f"{namespace}.{name}"
    if not all(_NAME.match(part) for part in full.split(".")):
        raise ValueError(f"Illegal name: {full}")
    return full


def normal_form(node: object, namespace: str | None = None, known: set[str] | None = None, aliases: bool = False) -> object:
    """A definition with full names and without what equality ignores (doc, and aliases unless they are asked for).
    Field order is kept. Raises ValueError where Avro would refuse to parse."""
    known = set() if known is None else known
    if isinstance(node, str):
        if node in PRIMITIVES:
            return node
        full = _full_name(node, namespace)
        if full not in known:
            raise ValueError(f"Undefined name: {full}")
        return full
    if isinstance(node, list):
        if any(isinstance(branch, list) for branch in node):
            raise ValueError(f"Nested union: {json.dumps(node)}")
        branches = [normal_form(branch, namespace, known, aliases) for branch in node]
        kinds = [_branch(b) for b in branches]
        for kind in kinds:
            if kinds.count(kind) > 1:
                raise ValueError(f"Duplicate in union: {kind}")
        return branches
    if not isinstance(node, dict) or "type" not in node:
        raise ValueError(f"No type: {json.dumps(node)}")

    kind = node["type"]
    props = {k: v for k, v in node.items() if k not in ("type", "name", "namespace", "doc", "aliases", "fields", "items", "values")}
    if kind in ("array", "map"):
        part = "items" if kind == "array" else "values"
        if part not in node:
            raise ValueError(f"No {part} type: {json.dumps(node)}")
        return {**props, "type": kind, part: normal_form(node[part], namespace, known, aliases)}
    if kind not in NAMED:
        inner = normal_form(kind, namespace, known, aliases)
        return {**props, "type": inner} if props else inner

    if "name" not in node:
        raise ValueError(f"No name in schema: {json.dumps(node)}")
    full = _full_name(node["name"], node.get("namespace", namespace))
    if full in known:
        raise ValueError(f"Can't redefine: {full}")
    known.add(full)
    out = {**props, "type": kind, "name": full}
    if aliases and node.get("aliases"):
        out["aliases"] = [_full_name(a, full.rpartition(".")[0]) for a in node["aliases"]]
    if kind in ("record", "error"):
        if not isinstance(node.get("fields"), list):
            raise ValueError(f"Record has no fields: {json.dumps(node)}")
        inner_space = full.rpartition(".")[0] or None
        out["fields"] = [_field(f, inner_space, known, aliases) for f in node["fields"]]
        names = [f["name"] for f in out["fields"]]
        if len(set(names)) < len(names):
            raise ValueError(f"Duplicate field in record {full}")
    elif kind == "enum":
        symbols = node.get("symbols")
        if not isinstance(symbols, list):
            raise ValueError(f"Enum has no symbols: {json.dumps(node)}")
        for symbol in symbols:
            if not isinstance(symbol, str) or not _NAME.match(symbol):
                raise ValueError(f"Illegal name: {symbol}")
            if symbols.count(symbol) > 1:
                raise ValueError(f"Duplicate enum symbol: {symbol}")
        if "default" in node and node["default"] not in symbols:
            raise ValueError(f"The enum default is no symbol: {node['default']}")
    elif kind == "fixed" and not isinstance(node.get("size"), int):
        raise ValueError(f"Invalid or no size: {json.dumps(node)}")
    return out


def _field(field: object, namespace: str | None, known: set[str], aliases: bool) -> dict:
    if not isinstance(field, dict) or "name" not in field or "type" not in field:
        raise ValueError(f"No field name or type: {json.dumps(field)}")
    _full_name(field["name"], None)
    order = field.get("order", "ascending")
    if order not in ("ascending", "descending", "ignore"):
        raise ValueError(f"Invalid order: {order}")
    # Ascending is what no order means.
    rest = {k: v for k, v in field.items() if k not in ("doc", "aliases", "type") and (k, v) != ("order", "ascending")}
    if aliases and field.get("aliases"):
        rest["aliases"] = list(field["aliases"])
    form = normal_form(field["type"], namespace, known, aliases)
    if "default" in field and not _fits(form, field["default"]):
        raise ValueError(f"Invalid default for field {field['name']}: {json.dumps(field['default'])}")
    return {**rest, "type": form}


def _branch(form: object) -> str:
    """What must be different between the branches of a union: the name of a named type, else the kind."""
    if isinstance(form, dict):
        return form["name"] if form["type"] in NAMED else _branch(form["type"])
    return form


def _fits(form: object, value: object) -> bool:
    """Whether a JSON value can be the default of a type. A type that is known by name only is not looked into."""
    if isinstance(form, list):
        return any(_fits(branch, value) for branch in form)
    kind = form["type"] if isinstance(form, dict) else form
    if isinstance(kind, (dict, list)):
        return _fits(kind, value)
    whole = isinstance(value, int) and not isinstance(value, bool)
    if kind == "null":
        return value is None
    if kind == "boolean":
        return isinstance(value, bool)
    if kind in ("int", "long"):
        return whole and abs(value) <= (1 << (31 if kind == "int" else 63))
    if kind in ("float", "double"):
        return whole or isinstance(value, float)
    if kind in ("string", "bytes", "fixed"):
        return isinstance(value, str)
    if kind == "enum":
        return value in form["symbols"]
    if kind == "array":
        return isinstance(value, list) and all(_fits(form["items"], v) for v in value)
    if kind == "map":
        return isinstance(value, dict) and all(_fits(form["values"], v) for v in value.values())
    if kind in ("record", "error"):
        return isinstance(value, dict) and all(
            _fits(f["type"], value[f["name"]]) if f["name"] in value else "default" in f for f in form["fields"])
    return True


# Spark's types of Avro's primitive ones.
_SPARK = {"boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
          "double": T.DoubleType(), "bytes": T.BinaryType(), "string": T.StringType()}


def spark_type(form: object, names: dict[str, dict] | None = None, above: tuple[str, ...] = ()) -> T.DataType:
    """Spark's type of a normal form; `names` has its named types. A union of null and one type is that type, one of
    several a struct with a field for each of them (member0, member1, ...)."""
    names = {} if names is None else names
    if isinstance(form, list):
        types = [spark_type(branch, names, above) for branch in form if branch != "null"]
        if len(types) == 1:
            return types[0]
        return T.StructType([T.StructField(f"member{n}", t) for n, t in enumerate(types)]) if types else T.NullType()
    kind = form["type"] if isinstance(form, dict) else form
    if isinstance(kind, (dict, list)):
        return spark_type(kind, names, above)
    if kind == "union":
        return spark_type(form["branches"], names, above)
    if kind == "array":
        return T.ArrayType(spark_type(form["items"], names, above))
    if kind == "map":
        return T.MapType(T.StringType(), spark_type(form["values"], names, above))
    if kind in ("record", "error"):
        if form["name"] is not None and form["name"] in above:
            raise ValueError(f"recursive type: {form['name']}")
        inside = above if form["name"] is None else (*above, form["name"])
        return T.StructType([T.StructField(f["name"], spark_type(f["type"], names, inside)) for f in form["fields"]])
    if kind in ("enum", "fixed"):
        return T.StringType() if kind == "enum" else T.BinaryType()
    if kind == "spark":
        return T.StructType.fromDDL(f"x {form['as']}")["x"].dataType
    if kind in names:
        return spark_type(names[kind], names, above)
    if kind == "null":
        return T.NullType()
    if kind not in _SPARK:
        raise ValueError(f"no Spark type: {kind}")
    return _SPARK[kind]


def _normalise(definition: str | None) -> tuple:
    try:
        form = normal_form(json.loads(definition or ""))
    except (ValueError, TypeError) as e:
        return None, str(e)
    return json.dumps(form, sort_keys=True, separators=(",", ":")), None


_RESULT = T.StructType([T.StructField("canonical", T.StringType()), T.StructField("problem", T.StringType())])


@F.pandas_udf(_RESULT)
def canonical(definitions: pd.Series) -> pd.DataFrame:
    """Normal form of each definition, or why it is none."""
    return pd.DataFrame([_normalise(d) for d in definitions], columns=["canonical", "problem"])


# Otherwise Spark moves filters on the outcome, and Python with them, below the aggregate that
# reduces the rows to distinct definitions.
canonical = canonical.asNondeterministic()
