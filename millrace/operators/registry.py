"""The schema registry as tables.

A store has the columns id, subject, format, version, definition and canonical (the definition's
normal form, by which equality is judged)."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.envelope import CONTENT_TYPE, put_headers
from millrace.functions.avro import canonical, normal_form, spark_type
from millrace.functions.resolution import UNRESOLVABLE, Resolution, Unresolvable, named_types, reader_form
from millrace.ordering import with_running
from millrace.session import folder_names, path_exists, stored

STORE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("subject", T.StringType()),
        T.StructField("format", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("definition", T.StringType()),
        T.StructField("canonical", T.StringType()),
    ]
)
FORMATS = ("avro",)
UNKNOWN_VERSION = "UnknownSchemaVersion"

# Different definitions that one resolution can choose among.
MAX_PLANS = 200

_ARRIVALS_PER_SLICE = 1_000_000


def empty_store(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STORE)


def save(store: DataFrame, path: str) -> DataFrame:
    """Write the store as the next version under `path` and read it back, as the table the next operations start from.

    Earlier versions stay, so a store can be saved to where it was loaded from, and a save that fails changes nothing."""
    versions = _versions(store.sparkSession, path)
    store.write.parquet(f"{path}/store-{max(versions, default=0) + 1:08d}")
    return load(store.sparkSession, path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the store that was written to its end; an empty store if there is none."""
    versions = _versions(spark, path)
    done = [n for n in versions if path_exists(spark, f"{path}/store-{n:08d}/_SUCCESS")]
    return spark.read.schema(STORE).parquet(f"{path}/store-{max(done):08d}") if done else empty_store(spark)


def _versions(spark: SparkSession, path: str) -> list[int]:
    return [int(name[len("store-"):]) for name in folder_names(spark, path) if name.startswith("store-")]


def validate(requests: DataFrame) -> DataFrame:
    """Distinct (subject, format, definition) with first arrival, number of requests, normal form
    and problem (null if valid). Python sees each distinct definition once."""
    distinct = requests.groupBy("subject", "format", "definition").agg(
        F.min("arrival").alias("arrival"), F.count(F.lit(1)).alias("requests"))
    checked = distinct.withColumn("_c", canonical("definition"))
    unknown = F.when(~F.col("format").isin(*FORMATS), F.concat(F.lit("Invalid format, supported types are: "), F.lit(",".join(FORMATS))))
    return checked.select("subject", "format", "definition", "arrival", "requests", "_c.canonical",
                          F.coalesce(unknown, F.col("_c.problem")).alias("problem"))


def register(store: DataFrame, requests: DataFrame) -> DataFrame:
    """The store after bulk registration of (subject, format, definition, arrival) requests.

    A definition equal to a stored one changes nothing; others get the next versions of their
    subject and format, and the next ids, by arrival. Invalid ones are left out, see `validate`."""
    valid = validate(requests).filter(F.col("problem").isNull())
    same = ["subject", "format", "canonical"]
    new = valid.groupBy(*same).agg(F.min_by("definition", "arrival").alias("definition"), F.min("arrival").alias("arrival"))
    new = new.join(store.select(*same), same, "left_anti")
    # Distinct new schemas are few; stored once, the requests are read once.
    new = stored(new, "new-schemas")
    slices = F.floor(F.col("arrival") / _ARRIVALS_PER_SLICE)
    new = with_running(new, ["subject", "format"], [F.col("arrival"), F.col("canonical")], position="_n", slice_by=slices)
    new = with_running(new.withColumn("_all", F.lit(0)), ["_all"],
                       [F.col("arrival"), F.col("subject"), F.col("canonical")], position="_k", slice_by=slices)
    last = store.groupBy("subject", "format").agg(F.max("version").alias("_version"))
    last_id = store.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_id")).scalar()
    numbered = new.join(last, ["subject", "format"], "left").select(
        (last_id + F.col("_k") + 1).alias("id"), "subject", "format",
        (F.coalesce("_version", F.lit(0)) + F.col("_n") + 1).alias("version"), "definition", "canonical")
    return store.unionByName(numbered)


def answer(store: DataFrame, requests: DataFrame) -> DataFrame:
    """The registered row each distinct request ends up with."""
    same = ["subject", "format", "canonical"]
    return (validate(requests).filter(F.col("problem").isNull())
            .join(store.select(*same, "id", "version"), same).drop("canonical", "problem"))


def find(store: DataFrame, requests: DataFrame, *by: str) -> tuple[DataFrame, DataFrame]:
    """(found, missing) for a table of requests with the columns `by`: subject, format and version;
    or id; or subject and format for all versions, ascending when sorted by `version`."""
    wanted = requests.select(*by)
    return store.join(wanted.distinct(), list(by)), wanted.join(store.select(*by), list(by), "left_anti")


def delete(store: DataFrame, requests: DataFrame, *by: str, allowed: bool = False) -> DataFrame:
    """The store without what is named by version, id or subject."""
    if not allowed:
        raise PermissionError("schema deletion is not permitted")
    return store.join(requests.select(*by), list(by), "left_anti")


def subject_name(definition: Column, strategy: str = "short", prefix: str | None = None) -> Column:
    """Subject of a record definition: its short or full name in lower case, with an optional
    `prefix-`, or the prefix alone."""
    if strategy == "prefix":
        return F.lit(prefix)
    if strategy not in ("short", "full"):
        raise ValueError(f"unknown naming strategy: {strategy}")
    name = F.get_json_object(definition, "$.name")
    if strategy == "full":
        space = F.get_json_object(definition, "$.namespace")
        name = F.when(name.contains("."), name).otherwise(F.concat_ws(".", space, name))
    else:
        name = F.substring_index(name, ".", -1)
    return F.concat_ws("-", F.lit(prefix or None), F.lower(name))


def content_type_of(subject: Column, version: Column, prefix: str = "vnd") -> Column:
    return F.concat(F.lit(f"application/{prefix}."), subject, F.lit(".v"), version.cast("string"), F.lit("+avro"))


def stamp(df: DataFrame, store: DataFrame, prefix: str = "vnd") -> DataFrame:
    """Set the content type of rows that carry subject, format and canonical definition."""
    registered = store.select("subject", "format", "canonical", "version")
    stamped = df.join(registered, ["subject", "format", "canonical"])
    ct = content_type_of(F.col("subject"), F.col("version"), prefix)
    return stamped.withColumn("headers", put_headers({CONTENT_TYPE: ct}))


def reference(ct: Column, prefix: str = "vnd") -> Column:
    """struct(subject, version) named by a content type, or null."""
    pattern = f"application/{prefix}\\.([A-Za-z0-9$.]+)\\.v([0-9]+)\\+avro"
    subject = F.regexp_extract(ct, pattern, 1)
    version = F.regexp_extract(ct, pattern, 2)
    return F.when(subject != "", F.struct(subject.alias("subject"), version.try_cast("bigint").alias("version")))


def resolve(
    df: DataFrame, store: DataFrame, reader: T.StructType | str, defaults: dict[str, object] | None = None,
    subjects: Sequence[str] | None = None,
) -> DataFrame:
    """Read JSON payloads, each written with the version in its content type, as the reader's schema: adds `data` and
    `error`. A tombstone has neither. Rows without a reference are read as the reader's own, with its defaults for fields
    that are missing.

    reader: an Avro definition, or Spark's type with `defaults` beside it, whose fields may all be null. Each different
    definition in the store is compiled once against it (`functions.resolution` has the rules) into one expression, and
    the row's version chooses among them; a payload is parsed once, whatever wrote it. Errors begin with their kind:
    UnknownSchemaVersion (the store has no such version), UnresolvableSchema, MalformedPayload, WrongType, MissingField
    and UnknownSymbol, the last three with the field.

    The plan grows with the different definitions of the store, of which there may be `MAX_PLANS`; name the `subjects`
    that can occur where it holds more. A reference to another subject is an unknown version."""
    if isinstance(reader, str):
        form = normal_form(json.loads(reader), aliases=True)
        for field in form["fields"] if isinstance(form, dict) else ():
            if field["name"] in (defaults or {}):
                field["default"] = defaults[field["name"]]
    else:
        form = reader_form(reader, defaults or {})
    store = store.where(F.col("format") == "avro")
    if subjects is not None:
        store = store.where(F.col("subject").isin(*subjects))
    found = [r["canonical"] for r in store.select("canonical").distinct().limit(MAX_PLANS + 1).collect()]
    if len(found) > MAX_PLANS:
        raise ValueError(f"more than {MAX_PLANS} different definitions in the store; name the subjects to read")

    payload, plan = F.col("_payload"), F.col("_plan")
    target, error, data = spark_type(form, named_types(form)), None, None
    for n, text in enumerate(sorted(found)):
        try:
            compiled = Resolution(json.loads(text), form)
            wrong, value = compiled.error(payload), compiled.value(payload)
        except Unresolvable as e:
            wrong, value = F.lit(f"{UNRESOLVABLE}: {e}"), None
        error = F.when(plan == n, wrong) if error is None else error.when(plan == n, wrong)
        if value is not None:
            data = F.when(plan == n, value) if data is None else data.when(plan == n, value)
    own = Resolution(None, form)
    error = own.error(payload) if error is None else error.otherwise(own.error(payload))
    data = own.value(payload) if data is None else data.otherwise(own.value(payload))

    plans = df.sparkSession.createDataFrame(list(enumerate(sorted(found))), "_plan int, canonical string")
    writers = store.join(plans, "canonical").select(F.col("subject").alias("_subject"), F.col("version").alias("_version"), "_plan")
    keyed = df.withColumn("_ref", reference(F.try_element_at("headers", F.lit(CONTENT_TYPE))))
    joined = keyed.join(writers, (F.col("_ref.subject") == F.col("_subject")) & (F.col("_ref.version") == F.col("_version")), "left")
    # What generators give is not copied into filters and later projections: one parse, one search for errors.
    parsed = joined.withColumn("_payload", F.explode(F.array(F.try_parse_json(F.col("value").cast("string")))))
    unknown = F.col("_ref").isNotNull() & plan.isNull()
    error = F.when(F.col("value").isNotNull(), F.when(unknown, F.lit(UNKNOWN_VERSION)).otherwise(error))
    judged = parsed.withColumn("_error", F.explode(F.array(error.cast("string"))))
    fine = F.col("value").isNotNull() & F.col("_error").isNull()
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("data", "error")]
    return judged.select(*kept, F.when(fine, data).cast(target).alias("data"), F.col("_error").alias("error"))


def resolve_binary(df: DataFrame, writer: str, reader: str) -> DataFrame:
    """The same for binary Avro payloads of one writer version; needs Spark's Avro module."""
    from pyspark.sql.avro.functions import from_avro

    return df.withColumn("data", from_avro("value", writer, {"avroSchema": reader, "mode": "FAILFAST"}))


def split_union(requests: DataFrame) -> DataFrame:
    """One request for each member of a definition that is a list of schemas; others stay."""
    members = F.when(F.ltrim("definition").startswith("["), F.from_json("definition", "array<string>"))
    return requests.withColumn("definition", F.explode(F.coalesce(members, F.array("definition"))))
