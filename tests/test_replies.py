from __future__ import annotations

import json

import pytest

from runlens.functions.replies import (
    BATCH_FIELDS,
    SESSION_FIELDS,
    compact_json,
    explode_jobs,
    numeric_id,
    parse_replies,
)
from tests.conftest import rows


def bodies(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, body STRING")


MALFORMED = ['{"id": [}', '{"id" 4}', '{"log": ["a", }', "<p>502</p>", "", None, "[1]", "null", '"s"', "7"]
TRAILING = ['{"id": 1}}', '{"id": 1} x', '{"id": 1}{"id": 2}', '{"id": 1},{"id": 2}', '{"id": 1}]', '{"id": 1}] x',
            '{"id": 1},"x":{"id": 2}', '{"id": 1}],"x":[{"id": 2}', '{"id": 1},0],[{"id": 2}', '{"id": 1},0,{"id": 2}']


@pytest.mark.parametrize("body", MALFORMED + TRAILING)
def test_malformed(spark, body):
    row = parse_replies(bodies(spark, body), "body", {"id": ("$.id", "string")}).first()
    assert (row.id, row.error, row.missing_path) == (None, "malformed", None)


def test_null_is_not_absent(spark):
    df = bodies(
        spark,
        '{"state": "success", "appId": "app_1"}',
        '{"state": "success", "appId": null}',
        '{"state": "success", "application": 12}',
        '{"appId": "app_1"}',
    )
    out = parse_replies(df, "body", {"state": ("$.state", "string"), "app": ("$.appId", "string")})
    assert [(r.state, r.app, r.error, r.missing_path) for r in out.orderBy("i").collect()] == [
        ("success", "app_1", None, None),
        ("success", None, None, None),
        ("success", None, "missing_path", "$.appId"),
        (None, "app_1", "missing_path", "$.state"),
    ]


def test_nested_paths(spark):
    df = bodies(
        spark,
        '{"output": {"status": "ok"}}',
        '{"output": {"result": 4}}',
        '{"output": null}',
        '{"output": "text"}',
        '{"output": {"status": null}}',
    )
    out = parse_replies(df, "body", {"status": ("$.output.status", "string")}).orderBy("i").collect()
    assert [r.error for r in out] == [None, "missing_path", "missing_path", "missing_path", None]


def test_values_are_typed(spark):
    df = bodies(spark, ' {"a": 5, "b": {"c": 1.5}, "d": "t", "e": [1, 2]}')
    fields = {
        "a": ("$.a", "bigint"), "c": ("$.b.c", "double"), "d": ("$.d", "string"),
        "e": ("$.e", "array<int>"), "bad": ("$.d", "bigint"),
    }
    row = parse_replies(df, "body", fields).first()
    assert (row.a, row.c, row.d, row.e, row.bad, row.error) == (5, 1.5, "t", [1, 2], None, None)


@pytest.mark.parametrize(
    "body,expected",
    [
        ('{"id": 123}', ("123", None)),
        ('{"id": -1.5}', ("-1.5", None)),
        ('{"id": 123456789012345678901234567890}', ("123456789012345678901234567890", None)),
        ('{"id": "four"}', (None, "not_a_number")),
        ('{"id": "123"}', (None, "not_a_number")),
        ('{"id": true}', (None, "not_a_number")),
        ('{"id": null}', (None, "not_a_number")),
        ('{"id": {}}', (None, "not_a_number")),
        ('{"no": 1}', (None, "missing_path")),
        ('{"id": 4', (None, "malformed")),
    ],
)
def test_numeric_id(spark, body, expected):
    row = numeric_id(bodies(spark, body), "body").first()
    assert (row.id, row.error) == expected


def test_job_lists(spark):
    df = bodies(
        spark,
        '[{"jobId": 1, "status": "SUCCEEDED"}, {"jobId": 2, "status": "FAILED"}]',
        "[]",
        '{"jobs": []}',
        '[{"jobId": 1, "status": "SUCCEEDED"}',
        '[{"jobId": 1}, 5, {"jobId": 3, "status": null}]',
        None,
        '[{"jobId":1,"status":"SUCCEEDED"}],"x":[{"jobId":2,"status":"FAILED"}]',
        '[{"jobId":1,"status":"SUCCEEDED"}],0,[{"jobId":2,"status":"FAILED"}]',
    )
    assert rows(explode_jobs(df, "body").drop("body")) == sorted(
        [
            (0, 0, 1, "SUCCEEDED", None),
            (0, 1, 2, "FAILED", None),
            (2, None, None, None, "malformed"),
            (3, None, None, None, "malformed"),
            (4, 0, 1, None, "missing_path"),
            (4, 1, None, None, "missing_path"),
            (4, 2, 3, None, None),
            (5, None, None, None, "malformed"),
            (6, None, None, None, "malformed"),
            (7, None, None, None, "malformed"),
        ],
        key=repr,
    )


VALUES = {
    "STRING": "some text",
    "INT": 7,
    "ARRAY<STRING>": ["one"],
    "MAP<STRING,STRING>": {"spark.ui.port": "0"},
}
KINDS = {"driver_cores": "INT", "executor_cores": "INT", "num_executors": "INT", "heartbeat_timeout": "INT"}
KINDS |= dict.fromkeys(("arguments", "jars", "py_files", "files", "archives"), "ARRAY<STRING>")
KINDS |= {"conf": "MAP<STRING,STRING>"}


@pytest.mark.parametrize("mapping", [BATCH_FIELDS, SESSION_FIELDS], ids=["batch", "session"])
def test_every_field_gets_its_name(spark, mapping):
    """One filled column at a time, all others NULL: the record holds that field alone."""
    ddl = ", ".join(f"{name} {KINDS.get(name, 'STRING')}" for name in mapping)
    wanted = [(name, VALUES[KINDS.get(name, "STRING")]) for name in mapping]
    table = [tuple(value if other == name else None for other in mapping) for name, value in wanted]
    found = compact_json(spark.createDataFrame(table, ddl), mapping).select("payload").collect()
    assert [json.loads(r.payload) for r in found] == [{mapping[name]: value} for name, value in wanted]


def test_empty_fields_are_dropped(spark):
    df = spark.createDataFrame(
        [("", 0, 0.0, [], {}, None, False)],
        "file STRING, driver_cores INT, num_executors DOUBLE, jars ARRAY<STRING>, "
        "conf MAP<STRING,STRING>, name STRING, queue BOOLEAN",
    )
    assert compact_json(df, BATCH_FIELDS).first().payload == "{}"
