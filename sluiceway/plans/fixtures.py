"""Event lines and JSON derived from the driver's tables, with an invented schema registry."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.keys import URI_SCHEME
from sluiceway.operators.registry import compile_registry, registry_from_rows
from sluiceway.sources import store
from sluiceway.sources.lines import dealt

ATOMIC = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("collector_tstamp", T.TimestampType(), False),
    T.StructField("event_name", T.StringType(), True),
    T.StructField("unstruct", T.StringType(), True),
    T.StructField("contexts", T.StringType(), True),
])
LAYOUT = {"unstruct": "unstruct", "contexts": ("contexts",), "enveloped": False}

# Fixed values of the fixture: the event types and the criteria used by the queries.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
SKIP = ("iglu:com.acme/error/jsonschema/*-*-*",)
LEGACY = ("iglu:com.acme/view/jsonschema/1-0-*",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared_out(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The columns of a table whose rows become lines or JSON, in equal shares for all cores."""
    rows = table(spark, sf_dir, name)
    return dealt(rows.select(*columns) if columns else rows)


def enriched_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tab-separated line per event; some are malformed, mistyped or of an unknown schema."""
    return _shared_out(spark, sf_dir, "events").select(_line(F.col("ts")).alias("value"))


def _line(moment: Column) -> Column:
    i = F.col("event_id")
    vendor = F.when(i % 103 == 0, "com.unknown").otherwise("com.acme")
    data = F.when(i % 101 == 0, '{"k":"xyz"}').otherwise(F.col("props"))
    unstruct = F.concat(
        F.lit('{"schema":"iglu:'), vendor, F.lit("/"), F.col("event_type"), F.lit("/jsonschema/1-0-"),
        (i % 3).cast("string"), F.lit('","data":'), data, F.lit("}"),
    )
    contexts = F.concat(
        F.lit('[{"schema":"iglu:com.acme/user_ctx/jsonschema/1-0-0","data":{"userId":'),
        F.col("user_id").cast("string"), F.lit("}}]"),
    )
    line = F.concat_ws(
        "\t", i.cast("string"), F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSS"), F.col("event_type"), unstruct, contexts
    )
    return F.when(i % 97 == 0, F.concat(F.lit("nonsense"), i.cast("string"))).otherwise(line)


def sourced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines with the moment at which the source got each, malformed ones too."""
    moments = _shared_out(spark, sf_dir, "events").withColumn("source_tstamp", F.col("ts").cast("timestamp"))
    return moments.select(_line(F.col("source_tstamp")).alias("value"), "source_tstamp")


def _schema(properties: dict, required: list[str]) -> str:
    return json.dumps({"type": "object", "properties": properties, "required": required})


def acme_schemas() -> list[tuple[str, str]]:
    """Registry of the fixture. The vendor ``com.unknown`` is absent on purpose."""
    number = {"type": "integer", "minimum": 0, "maximum": 1000}
    added = ({}, {"note": {"type": "string"}}, {"rank": {"type": "integer"}})
    rows = [
        (f"iglu:com.acme/{event}/jsonschema/1-0-{i}", _schema({"k": number} | extra, ["k"]))
        for event in EVENT_TYPES for i, extra in enumerate(added)
    ]
    return rows + [
        ("iglu:com.acme/user_ctx/jsonschema/1-0-0", _schema({"userId": {"type": "integer"}}, ["userId"]))
    ]


def acme_registry(spark: SparkSession) -> DataFrame:
    return compile_registry(registry_from_rows(spark, acme_schemas()))


def typed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per line item a shipping record: nested numbers, rates, dates, free JSON and a remark that is null."""
    ship = F.col("l_shipdate").cast("date").cast("string")
    columns = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    return _shared_out(spark, sf_dir, "lineitem", *columns).select(
        "l_orderkey", "l_linenumber",
        F.to_json(F.struct(
            F.struct(F.col("l_orderkey").alias("number"), F.col("l_linenumber").alias("line")).alias("order"),
            F.struct(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("stage")).alias("label"),
            F.array("l_discount", "l_tax").alias("rates"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
            (F.col("l_returnflag") == "R").alias("returned"),
            ship.alias("shipped_on"),
            F.concat(ship, F.lit("T07:45:10Z")).alias("packed_at"),
            F.from_json(F.lit("{}"), "map<string,string>").alias("extras"),
            F.lit(None).cast("string").alias("remark"),
        ), {"ignoreNullFields": "false"}).alias("j"),
    )


TYPED = T.StructType([
    T.StructField("order", T.StructType([
        T.StructField("number", T.LongType(), False), T.StructField("line", T.IntegerType(), False),
    ]), False),
    T.StructField("label", T.StructType([
        T.StructField("flag", T.StringType(), False), T.StructField("stage", T.VariantType(), False),
    ]), False),
    T.StructField("rates", T.ArrayType(T.DoubleType(), False), False),
    T.StructField("price", T.DecimalType(12, 2), False),
    T.StructField("returned", T.BooleanType(), False),
    T.StructField("shipped_on", T.DateType(), False),
    T.StructField("packed_at", T.TimestampType(), False),
    T.StructField("extras", T.VariantType(), False),
    T.StructField("remark", T.StringType(), True),
])


def array_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event an array with null members, an empty array, or only a null."""
    i = F.col("event_id").cast("string")
    following = (F.col("event_id") + 1).cast("string")
    full = F.concat(F.lit('{"a":['), i, F.lit(",null,"), following, F.lit("]}"))
    return _shared_out(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 7 == 0, '{"a":[null]}')
        .when(F.col("event_id") % 5 == 0, '{"a":[]}').otherwise(full).alias("j"),
    )


def record_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event an array of records: a number and tags, a null, and by turns a number that is text, a tag that is a number or a record that is none."""
    i, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    first = F.concat(F.lit('{"n":'), i, F.lit(',"tags":["a",null,"'), F.col("event_type"), F.lit('"]}'))
    second = (
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit('{"n":"x'), user, F.lit('","tags":[]}')))
        .when(F.col("event_id") % 7 == 0, F.concat(F.lit('{"n":'), user, F.lit(',"tags":["b",'), i, F.lit("]}")))
        .when(F.col("event_id") % 11 == 0, F.concat(F.lit("["), i, F.lit("]")))
        .otherwise(F.concat(F.lit('{"n":'), user, F.lit("}")))
    )
    return _shared_out(spark, sf_dir, "events").select("event_id", F.concat(F.lit('{"rows":['), first, F.lit(",null,"), second, F.lit("]}")).alias("j"))


RECORDS = T.StructType([T.StructField("rows", T.ArrayType(T.StructType([
    T.StructField("n", T.LongType(), False), T.StructField("tags", T.ArrayType(T.StringType(), True), True),
]), True), False)])


ENVELOPED_ATOMIC = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("collector_tstamp", T.TimestampType(), False),
    T.StructField("event_name", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("is_sale", T.BooleanType(), True),
    T.StructField("unstruct_event", T.StringType(), True),
    T.StructField("contexts", T.StringType(), True),
    T.StructField("derived_contexts", T.StringType(), True),
])


def enveloped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with envelopes and derived contexts: nested records, JSON and arrays as contexts.

    Purchases have no self-describing event and errors have no contexts at all.
    """
    def envelope(name, data):
        return F.concat(F.lit(f'{{"schema":"iglu:com.acme/{name}/jsonschema/1-0-0","data":'), data, F.lit("}"))

    number = F.col("value").cast("decimal(12,2)").cast("string")
    unstruct = F.when(F.col("event_type") == "purchase", "").otherwise(envelope("envelope", F.concat(
        F.lit('{"schema":"iglu:com.acme/'), F.col("event_type"), F.lit('/jsonschema/1-0-0","data":'),
        F.col("props"), F.lit("}"),
    )))
    user = F.concat(F.lit('{"schema":"iglu:com.acme/user_ctx/jsonschema/1-0-0","data":{"userId":'),
                    F.col("user_id").cast("string"), F.lit("}}"))
    place = F.concat(
        F.lit('{"schema":"iglu:com.acme/placeSeen/jsonschema/1-0-0","data":{"amount":'), number,
        F.lit(',"detail":{"z":1,"a":"'), F.col("event_type"), F.lit('"},"spot":{"siteID":"s'),
        F.col("user_id").cast("string"), F.lit('","tags":["x",null,"'), F.col("event_type"), F.lit('"]}}}'),
    )
    contexts = F.when(F.col("event_type") == "error", "").otherwise(
        envelope("contexts", F.concat(F.lit("["), user, F.lit(","), place, F.lit("]"))))
    derived = F.when(F.col("event_type") == "error", "").otherwise(
        envelope("contexts", F.concat(F.lit("["), user, F.lit("]"))))
    return _shared_out(spark, sf_dir, "events").select(F.concat_ws(
        "\t", F.col("event_id").cast("string"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"),
        F.col("event_type"), number, F.when(F.col("event_type") == "purchase", "1").otherwise("0"),
        unstruct, contexts, derived,
    ).alias("value"))


def place_schema() -> tuple[str, str]:
    nullable_text = {"type": ["string", "null"]}
    return ("iglu:com.acme/placeSeen/jsonschema/1-0-0", _schema({
        "amount": {"type": "number", "multipleOf": 0.01, "minimum": 0, "maximum": 1000000},
        "detail": {"type": "object"},
        "spot": {
            "type": "object",
            "properties": {"siteID": {"type": "string"}, "tags": {"type": "array", "items": nullable_text}},
            "required": ["siteID"],
        },
    }, ["amount", "detail"]))


def place_registry(spark: SparkSession) -> DataFrame:
    return compile_registry(registry_from_rows(spark, acme_schemas() + [place_schema()]))


def drifting_registry(spark: SparkSession) -> DataFrame:
    """Families whose second version widens ``k`` and whose third one cannot be merged."""
    kinds = ({"type": "integer", "minimum": 0, "maximum": 1000}, {"type": "number"}, {"type": ["object", "integer"]})
    rows = [
        (f"iglu:com.acme/{event}/jsonschema/1-0-{i}", _schema({"k": kind}, ["k"]))
        for event in EVENT_TYPES for i, kind in enumerate(kinds)
    ]
    return compile_registry(registry_from_rows(spark, rows + acme_schemas()[-1:]))


def put_schemas(spark: SparkSession, folder: str, rows: list[tuple[str, str]]) -> None:
    """Schemas as files below a folder, each put at once."""
    for uri, doc in rows:
        store.put_if_absent(spark, f"{folder}/{uri.removeprefix(URI_SCHEME)}", doc)


def _event_line(unstruct: Column, contexts: Column) -> Column:
    return F.concat_ws("\t", F.col("event_id").cast("string"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), F.col("event_type"), unstruct, contexts).alias("value")


def _entity(name: str, data: Column, version: str = "1-0-0", vendor: str = "com.acme") -> Column:
    return F.concat(F.lit(f'{{"schema":"iglu:{vendor}/{name}/jsonschema/{version}","data":'), data, F.lit("}"))


# The one column names of each pair of schemas would come to, and the legacy one of them.
PAGE_VIEW = "unstruct_event_com_acme_page_view_1"
ITEM = "unstruct_event_com_acme_item_1_0_1"
TWIN_LEGACY = ("iglu:com.acme/item/jsonschema/*-*-*",)


def twin_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views of two schemas that differ in spelling, and items of a legacy version and of a schema that is named like it."""
    text = lambda letter: F.concat(F.lit(f'{{"k":"{letter}'), F.col("user_id").cast("string"), F.lit('"}'))
    unstruct = (
        F.when(F.col("event_type") == "click", _entity("pageView", F.col("props")))
        .when(F.col("event_type") == "view", _entity("page_view", text("v")))
        .when(F.col("event_type") == "purchase", _entity("item", F.col("props"), "1-0-1"))
        .when(F.col("event_type") == "signup", _entity("item_1_0", text("s")))
        .otherwise("")
    )
    return _shared_out(spark, sf_dir, "events").select("event_type", _event_line(unstruct, F.lit("")))


def twin_registry(spark: SparkSession) -> DataFrame:
    number, text = _schema({"k": {"type": "integer"}}, ["k"]), _schema({"k": {"type": "string"}}, ["k"])
    kinds = {"pageView/jsonschema/1-0-0": number, "page_view/jsonschema/1-0-0": text, "item/jsonschema/1-0-1": number, "item_1_0/jsonschema/1-0-0": text}
    return compile_registry(registry_from_rows(spark, [(f"iglu:com.acme/{key}", doc) for key, doc in kinds.items()]))


FAULTY_LEGACY = ("iglu:com.acme/note/jsonschema/*-*-*",)


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the remainder of the id by 9: a good order, then a missing member, a null, two wrong types, missing JSON, a wrong legacy context, a wrong order
    with that, a wrong order with an unknown context, and an invalid and an unknown context. Good orders have moments with and without fraction and offset.
    """
    i = F.col("event_id")
    case = i % 9
    k = F.concat(F.lit('"k":'), (F.col("user_id") % 1000).cast("string"))
    second = F.lpad((i % 60).cast("string"), 2, "0")
    moment = F.when(i % 2 == 0, F.concat(F.lit("2024-03-17T20:37:"), second, F.lit("."), F.lpad((i % 1000).cast("string"), 3, "0"), F.lit("456+02:00"))).otherwise(
        F.concat(F.lit("2024-03-17T20:37:"), second, F.lit("Z")))
    wrong = F.concat(F.lit('"k":"x'), F.col("user_id").cast("string"), F.lit('"'))
    data = (
        F.when(case == 1, F.lit('{"tag":"t","extra":{}}'))
        .when(case == 2, F.concat(F.lit("{"), k, F.lit(',"tag":null,"extra":{}}')))
        .when(case == 3, F.concat(F.lit("{"), wrong, F.lit(',"tag":5,"extra":[]}')))
        .when(case == 4, F.concat(F.lit("{"), k, F.lit(',"tag":"t"}')))
        .when(case.isin(6, 7), F.concat(F.lit("{"), wrong, F.lit(',"tag":"t","extra":{}}')))
        .otherwise(F.concat(F.lit("{"), k, F.lit(',"tag":"t","extra":{},"at":"'), moment, F.lit('"}')))
    )
    fine = _entity("note", F.lit('{"text":"n","body":{}}'))
    unknown = _entity("ctx", F.lit("{}"), vendor="com.unknown")
    contexts = (
        F.when(case.isin(5, 6), _entity("note", F.lit('{"text":null}')))
        .when(case == 7, F.concat(fine, F.lit(","), unknown))
        .when(case == 8, F.concat(_entity("broken", F.lit("{}")), F.lit(","), unknown))
        .otherwise(fine)
    )
    return _shared_out(spark, sf_dir, "events").select(_event_line(_entity("order", data), F.concat(F.lit("["), contexts, F.lit("]"))))


def faulty_registry(spark: SparkSession) -> DataFrame:
    order = _schema({
        "k": {"type": "integer", "minimum": 0, "maximum": 1000}, "tag": {"type": "string"}, "extra": {"type": "object"},
        "at": {"type": "string", "format": "date-time"},
    }, ["k", "tag", "extra"])
    note = _schema({"text": {"type": "string"}, "body": {"type": "object"}}, ["text", "body"])
    docs = {"order": order, "note": note, "broken": '{"properties":"none"}'}
    return compile_registry(registry_from_rows(spark, [(f"iglu:com.acme/{name}/jsonschema/1-0-0", doc) for name, doc in docs.items()]))


def relaxing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of two versions of their schema; of the second, every fifth id lacks the number."""
    later = F.col("event_id") % 3 != 0
    data = F.when(later & (F.col("event_id") % 5 == 0), "{}").otherwise(F.col("props"))
    version = F.when(later, "1").otherwise("0")
    unstruct = F.concat(F.lit('{"schema":"iglu:com.acme/'), F.col("event_type"), F.lit("/jsonschema/1-0-"), version, F.lit('","data":'), data, F.lit("}"))
    return _shared_out(spark, sf_dir, "events").select(later.alias("later"), _event_line(unstruct, F.lit("")))


def relaxing_registry(spark: SparkSession) -> DataFrame:
    """The number is required in the first version only."""
    rows = [
        (f"iglu:com.acme/{event}/jsonschema/1-0-{i}", _schema({"k": {"type": "integer"}}, required))
        for event in EVENT_TYPES for i, required in enumerate((["k"], []))
    ]
    return compile_registry(registry_from_rows(spark, rows))
