import json
import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sluiceway.operators.registry import compile_registry, registry_from_rows  # noqa: E402
from sluiceway.streaming.loader import configure  # noqa: E402

ATOMIC = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("collector_tstamp", T.TimestampType(), False),
    T.StructField("event_name", T.StringType(), True),
    T.StructField("doc_height", T.IntegerType(), True),
    T.StructField("has_flash", T.BooleanType(), True),
    T.StructField("unstruct_event", T.StringType(), True),
    T.StructField("contexts", T.StringType(), True),
    T.StructField("derived_contexts", T.StringType(), True),
])


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("sluiceway-tests")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    configure(session)
    yield session
    session.stop()


def uri(name, version="1-0-0", vendor="org.shop"):
    return f"iglu:{vendor}/{name}/jsonschema/{version}"


def entity(name, data, version="1-0-0", vendor="org.shop"):
    return {"schema": uri(name, version, vendor), "data": data}


def line(event_id="e1", tstamp="2024-05-01 10:00:00.000", name="page", height="", flash="", unstruct=None,
         contexts=None, derived=None):
    def wrap(value):
        return "" if value is None else json.dumps({"schema": uri("envelope"), "data": value})
    return "\t".join([event_id, tstamp, name, height, flash, wrap(unstruct), wrap(contexts), wrap(derived)])


def schema(properties=None, required=(), **extra):
    doc = {"type": "object", "required": list(required), **extra}
    if properties is not None:
        doc["properties"] = properties
    return json.dumps(doc)


INT = {"type": "integer", "minimum": 0, "maximum": 100000}

DOCS = [
    (uri("cart"), schema({"itemCount": INT}, ["itemCount"])),
    (uri("cart", "1-0-1"), schema({"itemCount": INT, "note": {"type": "string"}}, ["itemCount"])),
    (uri("cart", "1-1-0"), schema({"itemCount": {"type": "number"}, "note": {"type": "string"}}, [])),
    (uri("cart", "1-2-0"), schema({"itemCount": {"type": "string"}}, [])),
    (uri("cart", "2-0-0"), schema({"sku": {"type": "string"}}, ["sku"])),
    (uri("nothing"), schema()),
    (uri("any-thing"), "{}"),
    (uri("broken"), '{"properties": "text"}'),
    (uri("no_json"), "not json"),
    (uri("deepOne"), schema({
        "outerBox": {"type": "object", "required": ["innerId"], "properties": {
            "innerId": {"type": "string"},
            "marks": {"type": "array", "items": {"type": "object", "properties": {"score": {"type": "integer"}}}},
        }},
        "when": {"type": "string", "format": "date-time"},
        "day": {"type": ["string", "null"], "format": "date"},
        "price": {"type": "number", "multipleOf": 0.01, "minimum": 0, "maximum": 1000},
        "shade": {"enum": ["red", "blue"]},
        "mixed": {"type": ["string", "integer"]},
    }, ["when", "day"])),
]


@pytest.fixture(scope="session")
def registry(spark):
    return compile_registry(registry_from_rows(spark, DOCS))


def lines_of(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")
