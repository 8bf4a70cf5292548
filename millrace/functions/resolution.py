"""Reading a JSON payload that one Avro definition wrote as another definition's Spark type.

A pair of definitions, writer and reader, is compiled once, in Python, into two column expressions over the parsed
payload (a variant): what is wrong with it, and its value. Rules are those of Avro's schema resolution: fields by name or
by the reader's aliases, defaults for what the writer lacks, wider numbers, bytes and strings for each other, symbols and
defaults of enumerations, branches of unions, and all of it inside arrays, maps and records.

Payloads are plain JSON. A union's value stands as it is, for the first branch it fits, or in Avro's own form, an object
whose only key is the branch's name. Bytes are texts of code points up to 255. A field that may be null may be missing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.avro import NAMED, PRIMITIVES, _fits, spark_type

MALFORMED, WRONG, MISSING = "MalformedPayload", "WrongType", "MissingField"
UNKNOWN_SYMBOL, UNRESOLVABLE = "UnknownSymbol", "UnresolvableSchema"

# What a reader's type can be read from besides itself: fixed rules of the Avro specification.
PROMOTIONS = {"long": {"int"}, "float": {"int", "long"}, "double": {"int", "long", "float"}, "string": {"bytes"}, "bytes": {"string"}}

_NUMBERS = {"int": "int", "long": "bigint", "float": "float", "double": "double"}


class Unresolvable(ValueError):
    """No payload of the writer can be read as the reader's type."""


def named_types(form: object, found: dict[str, dict] | None = None) -> dict[str, dict]:
    """The named types of a normal form by full name."""
    found = {} if found is None else found
    if isinstance(form, list):
        for branch in form:
            named_types(branch, found)
    elif isinstance(form, dict):
        if form.get("type") in NAMED and "name" in form:
            found[form["name"]] = form
        for part in (form["type"] if not isinstance(form["type"], str) else None, form.get("items"), form.get("values")):
            if part is not None:
                named_types(part, found)
        for field in form.get("fields", []):
            named_types(field["type"], found)
    return found


def reader_form(schema: T.StructType, defaults: dict[str, object]) -> dict:
    """A Spark type as a reader's form: every field may be null, and is so by default unless `defaults` has another
    value. Names of records count for nothing; types that Avro lacks are read by Spark's casts."""

    def form(kind: T.DataType) -> object:
        if isinstance(kind, T.StructType):
            return {"type": "record", "name": None, "fields": [{"name": f.name, "type": ["null", form(f.dataType)], "default": None} for f in kind.fields]}
        if isinstance(kind, T.ArrayType):
            return {"type": "array", "items": ["null", form(kind.elementType)]}
        if isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
            return {"type": "map", "values": ["null", form(kind.valueType)]}
        plain = {T.BooleanType: "boolean", T.IntegerType: "int", T.LongType: "long", T.FloatType: "float", T.DoubleType: "double",
                 T.BinaryType: "bytes", T.StringType: "string"}
        return plain.get(type(kind)) or {"type": "spark", "as": kind.simpleString()}

    out = form(schema)
    for field in out["fields"]:
        field["default"] = defaults.get(field["name"])
    return out


def as_written(form: object) -> object:
    """A reader's form as that of a writer: names of its own for records without one, and Spark's types as texts."""
    if isinstance(form, list):
        return [as_written(branch) for branch in form]
    if not isinstance(form, dict):
        return form
    if form["type"] == "spark":
        return "string"
    out = {k: as_written(v) if k in ("type", "items", "values") and not isinstance(v, str) else v for k, v in form.items()}
    if "fields" in form:
        out |= {"name": form["name"] or f"record{id(form)}", "fields": [{**f, "type": as_written(f["type"])} for f in form["fields"]]}
    return out


def _label(name: str, part: str) -> str:
    return f"{name}.{part}" if name else part


def _child(path: str, name: str) -> str:
    return f"{path}['{name}']"


def _get(x: Column, path: str, kind: str = "variant") -> Column:
    return x if (path, kind) == ("$", "variant") else F.try_variant_get(x, path, kind)


def _tag(x: Column, path: str) -> Column:
    """What kind of JSON value stands there: null if there is none, VOID for null."""
    return F.schema_of_variant(_get(x, path))


def _first(errors: list[Column | None]) -> Column | None:
    some = [e for e in errors if e is not None]
    return F.coalesce(*some) if len(some) > 1 else some[0] if some else None


class Resolution:
    """How payloads of one definition become values of another; both are normal forms, the reader's with aliases.

    Without a writer the payload is the reader's own, in which fields that have a default may be missing."""

    def __init__(self, writer: object | None, reader: object):
        self.lenient, self.reader = writer is None, reader
        self.writer = as_written(reader) if writer is None else writer
        self.written, self.read = named_types(self.writer), named_types(reader)
        self.type = spark_type(reader, self.read)
        if reason := self._mismatch(self.writer, reader, ()):
            raise Unresolvable(reason)

    def error(self, x: Column) -> Column:
        """What is wrong with a parsed payload, or null. A payload that is null counts as malformed."""
        found = self._check(x, "$", self.writer, self.reader, "", ())
        broken = F.when(x.isNull(), F.lit(MALFORMED))
        return broken if found is None else F.coalesce(broken, found)

    def value(self, x: Column) -> Column:
        """The reader's value of a payload without error."""
        return self._value(x, "$", self.writer, self.reader)

    # --- forms

    def _plain(self, form: object, names: dict[str, dict]) -> dict:
        """A form as a dictionary whose type is a kind: names looked up, wrappers taken off."""
        while True:
            if isinstance(form, list):
                return {"type": "union", "branches": form}
            if isinstance(form, str):
                if form in PRIMITIVES:
                    return {"type": form}
                form = names[form]
            elif isinstance(form["type"], str) and (form["type"] in NAMED | PRIMITIVES or form["type"] in ("array", "map", "union", "spark")):
                return form
            else:
                form = form["type"]

    def _w(self, form: object) -> dict:
        return self._plain(form, self.written)

    def _r(self, form: object) -> dict:
        return self._plain(form, self.read)

    # --- which types go together

    def _same_name(self, w: dict, r: dict) -> bool:
        if r["name"] is None:
            return True
        known = {r["name"], *r.get("aliases", [])}
        return w["name"] in known or w["name"].rpartition(".")[2] in {n.rpartition(".")[2] for n in known}

    def _field_of(self, w: dict, field: dict) -> dict | None:
        """The writer's field that a reader's field is read from: by its name, else by its aliases in their order."""
        by_name = {f["name"]: f for f in w["fields"]}
        return next((by_name[n] for n in (field["name"], *field.get("aliases", [])) if n in by_name), None)

    def _mismatch(self, w: object, r: object, seen: tuple) -> str | None:
        """Why no value of w can be read as r; None if some can."""
        w, r = self._w(w), self._r(r)
        if w["type"] == "union":
            reasons = [self._mismatch(branch, r, seen) for branch in w["branches"]]
            return None if not reasons or None in reasons else reasons[0]
        if r["type"] == "union":
            return None if self._branch(w, r, seen) is not None else f"no branch for {w.get('name') or w['type']}"
        if r["type"] == "spark":
            return None if w["type"] in PRIMITIVES | {"enum"} else f"{w['type']} is no {r['as']}"
        if w["type"] != r["type"]:
            return None if w["type"] in PROMOTIONS.get(r["type"], ()) else f"{w['type']} is no {r['type']}"
        if r["type"] in ("array", "map"):
            part = "items" if r["type"] == "array" else "values"
            return self._mismatch(w[part], r[part], seen)
        if r["type"] in NAMED and not self._same_name(w, r):
            return f"{w['name']} is no {r['name']}"
        if r["type"] == "fixed" and w["size"] != r["size"]:
            return f"{w['name']} has another size"
        if r["type"] in ("record", "error"):
            if w["name"] in seen:
                return f"recursive type {w['name']}"
            for field in r["fields"]:
                source = self._field_of(w, field)
                if source is None and "default" not in field:
                    return f"field {field['name']} has no default"
                reason = source and self._mismatch(source["type"], field["type"], (*seen, w["name"]))
                if reason:
                    return f"field {field['name']}: {reason}"
        return None

    def _branch(self, w: dict, r: dict, seen: tuple = ()) -> int | None:
        """Which of a reader's branches takes a writer's type: the first of the same type, else the first that can."""
        able = [n for n, branch in enumerate(r["branches"]) if self._mismatch(w, branch, seen) is None]
        same = [n for n in able if self._r(r["branches"][n])["type"] == w["type"]]
        return next(iter(same or able), None)

    # --- what is wrong with a payload

    def _check(self, x: Column, path: str, w: object, r: object, label: str, seen: tuple) -> Column | None:
        """Why the value at the path is none of w's, or cannot be read as r (None: it is not read); null if all is well."""
        w, r = self._w(w), None if r is None else self._r(r)
        kind, tag = w["type"], _tag(x, path)

        def unless(fits: Column, what: str = WRONG) -> Column:
            return F.when(~F.coalesce(fits, F.lit(False)), F.lit(f"{what}: {label}" if label else what))

        if kind == "union":
            return self._check_union(x, path, w, r, label, seen)
        if r is not None and r["type"] == "union":
            chosen = self._branch(w, r)
            return unless(F.lit(False), UNRESOLVABLE) if chosen is None else self._check(x, path, w, r["branches"][chosen], label, seen)
        if r is not None and self._mismatch(w, r, ()):
            return unless(F.lit(False), UNRESOLVABLE)
        if kind == "null":
            return unless(tag.isNull() | (tag == "VOID"))
        if kind == "boolean":
            return unless(tag == "BOOLEAN")
        if kind == "int":
            return unless((tag == "BIGINT") & _get(x, path, "int").isNotNull())
        if kind == "long":
            return unless(tag == "BIGINT")
        if kind in ("float", "double"):
            return unless(tag.isin("BIGINT", "DOUBLE", "FLOAT") | tag.startswith("DECIMAL"))
        if kind in ("string", "bytes", "fixed", "enum"):
            text = _get(x, path, "string")
            if kind == "string":
                return unless(tag == "STRING")
            if kind == "enum":
                wrong = unless((tag == "STRING") & text.isin(*w["symbols"]))
                if r is None or r["type"] != "enum" or "default" in r or set(w["symbols"]) <= set(r["symbols"]):
                    return wrong
                return F.coalesce(wrong, unless(text.isin(*r["symbols"]), UNKNOWN_SYMBOL))
            bytes_only = (tag == "STRING") & text.rlike("(?s)\\A[\\x{0}-\\x{FF}]*\\z")
            return unless(bytes_only & (F.length(text) == w["size"]) if kind == "fixed" else bytes_only)
        if kind in ("array", "map"):
            part = w["items" if kind == "array" else "values"]
            below = None if r is None else r["items" if kind == "array" else "values"]
            inside = f"{label}[]"
            wrong = unless(tag.startswith("ARRAY" if kind == "array" else "OBJECT"))
            values = _get(x, path, "array<variant>") if kind == "array" else F.map_values(_get(x, path, "map<string,variant>"))
            found = F.transform(values, lambda e: F.coalesce(self._check(e, "$", part, below, inside, seen), F.lit(None).cast("string")))
            return F.coalesce(wrong, F.get(F.filter(found, lambda e: e.isNotNull()), F.lit(0)))
        if w["name"] in seen:
            raise Unresolvable(f"recursive type {w['name']}")
        read = {} if r is None else {source["name"]: f for f in r["fields"] if (source := self._field_of(w, f)) is not None}
        errors: list[Column | None] = [unless(tag.startswith("OBJECT"))]
        for field in w["fields"]:
            place, name = _child(path, field["name"]), _label(label, field["name"])
            target = read[field["name"]]["type"] if field["name"] in read else None
            wrong = self._check(x, place, field["type"], target, name, (*seen, w["name"]))
            if self.lenient and "default" in field:
                errors.append(None if wrong is None else F.when(_get(x, place).isNotNull(), wrong))
                continue
            if not self._may_be_null(field["type"]):
                errors.append(F.when(_get(x, place).isNull(), F.lit(f"{MISSING}: {name}")))
            errors.append(wrong)
        return _first(errors)

    def _may_be_null(self, form: object) -> bool:
        w = self._w(form)
        return w["type"] == "null" or (w["type"] == "union" and any(self._w(b)["type"] == "null" for b in w["branches"]))

    def _options(self, x: Column, path: str, w: dict, label: str, seen: tuple) -> list[tuple[object, str, Column]]:
        """The branches of a writer's union: each with the path of its value and whether a value there is one; values
        as they are before those under the branch's name."""
        plain, named = [], []
        for branch in w["branches"]:
            form = self._w(branch)
            wrong = self._check(x, path, branch, None, label, seen)
            plain.append((branch, path, F.lit(True) if wrong is None else wrong.isNull()))
            if form["type"] != "null":
                place = _child(path, form.get("name") or form["type"])
                wrong = self._check(x, place, branch, None, label, seen)
                alone = _tag(x, path).startswith("OBJECT") & (F.size(F.map_keys(_get(x, path, "map<string,variant>"))) == 1)
                named.append((branch, place, alone & _get(x, place).isNotNull() & (F.lit(True) if wrong is None else wrong.isNull())))
        return plain + named

    def _check_union(self, x: Column, path: str, w: dict, r: dict | None, label: str, seen: tuple) -> Column | None:
        options = self._options(x, path, w, label, seen)
        others = [b for b in w["branches"] if self._w(b)["type"] != "null"]
        found = None
        for branch, place, fits in options:
            wrong = F.lit(None).cast("string") if r is None else self._check(x, place, branch, r, label, seen)
            wrong = F.lit(None).cast("string") if wrong is None else wrong
            found = F.when(fits, wrong) if found is None else found.when(fits, wrong)
        # With a single branch besides null, what that one lacks is what is wrong.
        last = self._check(x, path, others[0], None, label, seen) if len(others) == 1 else None
        return None if found is None else found.otherwise(F.lit(f"{WRONG}: {label}") if last is None else last)

    # --- what a payload without errors amounts to

    def _value(self, x: Column, path: str, w: object, r: object) -> Column:
        kind, w, r = spark_type(r, self.read), self._w(w), self._r(r)
        if w["type"] == "union":
            found = None
            for branch, place, fits in self._options(x, path, w, "", ()):
                if self._mismatch(branch, r, ()) is None:
                    value = self._value(x, place, branch, r)
                    found = F.when(fits, value) if found is None else found.when(fits, value)
            return F.lit(None).cast(kind) if found is None else found
        if r["type"] == "union":
            return self._member(r, self._branch(w, r), lambda branch: self._value(x, path, w, branch))
        if r["type"] == "null":
            return F.lit(None).cast(kind)
        if r["type"] == "spark":
            return _get(x, path, r["as"])
        if r["type"] in _NUMBERS:
            return _get(x, path, _NUMBERS[r["type"]])
        if r["type"] == "boolean":
            return _get(x, path, "boolean")
        if r["type"] in ("string", "bytes", "fixed", "enum"):
            text = _get(x, path, "string")
            raw = F.encode(text, "UTF-8" if w["type"] == "string" else "ISO-8859-1")
            if r["type"] == "enum":
                fallback = F.lit(r.get("default")).cast("string")
                return text if set(w["symbols"]) <= set(r["symbols"]) else F.when(text.isin(*r["symbols"]), text).otherwise(fallback)
            if r["type"] == "string":
                return raw.cast("string") if w["type"] == "bytes" else text
            return raw
        if r["type"] == "array":
            return F.transform(_get(x, path, "array<variant>"), lambda e: self._value(e, "$", w["items"], r["items"]))
        if r["type"] == "map":
            return F.transform_values(_get(x, path, "map<string,variant>"), lambda _, e: self._value(e, "$", w["values"], r["values"]))
        fields = []
        for field in r["fields"]:
            source = self._field_of(w, field)
            default = self._literal(field["type"], field["default"]) if source is None or (self.lenient and "default" in field) else None
            if source is None:
                fields.append(default.alias(field["name"]))
                continue
            place = _child(path, source["name"])
            value = self._value(x, place, source["type"], field["type"])
            fields.append((value if default is None else F.when(_get(x, place).isNull(), default).otherwise(value)).alias(field["name"]))
        return F.struct(*fields)

    def _member(self, r: dict, chosen: int | None, value: Callable[[object], Column]) -> Column:
        """The value of a reader's union: of one branch besides null as it is, of several as one field of a struct."""
        kind, others = spark_type(r["branches"], self.read), [n for n, b in enumerate(r["branches"]) if self._r(b)["type"] != "null"]
        if chosen not in others:
            return F.lit(None).cast(kind)
        if len(others) == 1:
            return value(r["branches"][chosen])
        return F.struct(*[(value(r["branches"][n]) if n == chosen else F.lit(None).cast(f.dataType)).alias(f.name) for n, f in zip(others, kind.fields)])

    def _literal(self, form: object, default: object) -> Column:
        """A default, which is JSON, as a value of the reader's type."""
        kind, r = spark_type(form, self.read), self._r(form)
        if r["type"] == "union":
            chosen = next((n for n, b in enumerate(r["branches"]) if _fits(self._r(b), default)), None)
            return self._member(r, chosen, lambda branch: self._literal(branch, default))
        if default is None:
            return F.lit(None).cast(kind)
        if r["type"] in ("bytes", "fixed"):
            return F.lit(default.encode("latin-1"))
        if r["type"] == "array":
            return F.array(*[self._literal(r["items"], v) for v in default]).cast(kind)
        if r["type"] == "map":
            parts = [p for k, v in default.items() for p in (F.lit(k), self._literal(r["values"], v))]
            return (F.create_map(*parts) if parts else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast(T.ArrayType(kind.valueType)))).cast(kind)
        if r["type"] in ("record", "error"):
            return F.struct(*[self._literal(f["type"], default[f["name"]] if f["name"] in default else f["default"]).alias(f["name"]) for f in r["fields"]])
        return F.lit(default).cast(kind)
