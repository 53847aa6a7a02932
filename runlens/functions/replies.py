"""JSON replies: typed columns, error classes, job lists, compact records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The reply is parsed as the first of two elements of a list, the second a hash of the
# reply: Spark's JSON parser stops at the end of the first value, so without it text
# after the reply would go unnoticed. Text that brings elements of its own, or closes
# the list, leaves something else at the second place; it cannot hold its own hash.
JSON_SPACE = " \t\n\r"
NUMERIC_VARIANT = "^(BIGINT|DECIMAL|DOUBLE|FLOAT)"


def with_parsed(df: DataFrame, body: str, opening: str, closing: str) -> DataFrame:
    """Add `_parsed`: a VARIANT with the reply under `$[0]`.

    NULL unless `body` is one JSON value between the given brackets. Those are looked
    at first: a reply that was cut short is told by its last character, which is far
    cheaper than having the parser fail on it. The hash is checked in a second step,
    so that each body is parsed once.
    """
    trimmed = F.btrim(F.col(body), F.lit(JSON_SPACE))
    whole = trimmed.startswith(opening) & trimmed.endswith(closing)
    mark = F.xxhash64(body)
    envelope = F.concat(F.lit("["), F.col(body), F.lit(","), mark.cast("string"), F.lit("]"))
    ends = F.try_variant_get(F.col("_envelope"), "$[1]", "bigint") == mark
    return (
        df.withColumn("_envelope", F.when(whole, F.try_parse_json(envelope)))
        .withColumn("_parsed", F.when(ends, F.col("_envelope")))
        .drop("_envelope")
    )


def reply_path(parsed: Column, path: str, kind: str = "variant") -> Column:
    """Value at `path` (`$.a.b`). With kind `variant`, NULL only if the path is absent."""
    return F.try_variant_get(parsed, "$[0]" + path.removeprefix("$"), kind)


def parse_replies(df: DataFrame, body: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Add one typed column per field plus `error` and `missing_path`.

    `fields` maps a column name to (path, type). `error` is `malformed` when the
    body is not a JSON object, `missing_path` when a wanted key is absent (the
    first such path in `missing_path`), else NULL. A key that is present with a
    null value is fine, and gives NULL. Objects that repeat a key are malformed.
    """
    parsed = F.col("_parsed")
    absent = F.coalesce(
        *[F.when(reply_path(parsed, path).isNull(), F.lit(path)) for path, _ in fields.values()],
        F.lit(None).cast("string"),
    )
    malformed = parsed.isNull()
    out = with_parsed(df, body, "{", "}")
    values = {name: reply_path(parsed, path, kind) for name, (path, kind) in fields.items()}
    return (
        out.withColumns(values)
        .withColumn("missing_path", F.when(~malformed, absent))
        .withColumn(
            "error",
            F.when(malformed, "malformed").when(F.col("missing_path").isNotNull(), "missing_path"),
        )
        .drop("_parsed")
    )


def statement_states(df: DataFrame, body: str) -> DataFrame:
    """Add `state`, `status` and `has_status` from replies about statements.

    The status matters only once the state is `available`; a reply that cannot be read,
    or has no state, gets its error class as its state. `has_status` tells a missing
    status from one that is null.
    """
    parsed = F.col("_parsed")
    state = reply_path(parsed, "$.state")
    error = F.when(parsed.isNull(), "malformed").when(state.isNull(), "missing_path")
    return (
        with_parsed(df, body, "{", "}")
        .withColumn("state", F.coalesce(error, reply_path(parsed, "$.state", "string")))
        .withColumn("status", reply_path(parsed, "$.output.status", "string"))
        .withColumn("has_status", reply_path(parsed, "$.output.status").isNotNull())
        .drop("_parsed")
    )


def numeric_id(df: DataFrame, body: str, path: str = "$.id") -> DataFrame:
    """Add `id` (as text) and `error`, which is `not_a_number` for a non-numeric id.

    Integers and decimals are numbers; quoted numbers, booleans and null are not.
    """
    parsed = F.col("_parsed")
    found = reply_path(parsed, path)
    malformed = parsed.isNull()
    numeric = F.schema_of_variant(found).rlike(NUMERIC_VARIANT)
    return (
        with_parsed(df, body, "{", "}")
        .withColumn(
            "error",
            F.when(malformed, "malformed")
            .when(found.isNull(), "missing_path")
            .when(~numeric, "not_a_number"),
        )
        .withColumn("id", F.when(F.col("error").isNull(), reply_path(parsed, path, "string")))
        .drop("_parsed")
    )


# Job lists as they mostly come: entries of an integer `jobId`, a plain `status`, or one of
# the two, each once and in either order. What is so is not only JSON, but holds nothing that
# a typed reader would overlook.
_SPACE = rf"[{JSON_SPACE}]*+"
_ID = rf'"jobId"{_SPACE}:{_SPACE}-?+(?:0|[1-9][0-9]{{0,17}}+){_SPACE}'
_STATUS = rf'"status"{_SPACE}:{_SPACE}"[^"\\\x00-\x1f]*+"{_SPACE}'
_ENTRY = rf"\{{{_SPACE}(?:{_ID}(?:,{_SPACE}{_STATUS})?+|{_STATUS}(?:,{_SPACE}{_ID})?+)?+\}}{_SPACE}"
PLAIN_JOBS = rf"\A{_SPACE}\[{_SPACE}(?:{_ENTRY}(?:,{_SPACE}{_ENTRY})*+)?+\]{_SPACE}\z"


def shredded_jobs(df: DataFrame, body: str, name: str = "jobs") -> DataFrame:
    """Add `name`: the entries of a JSON job list as an array of (job_id, status, error).

    NULL for a body that is not a list. The error of an entry is `missing_path` if it lacks
    `jobId` or `status`, and `bad_job_id` if its `jobId` is not an integer, as it stands:
    neither a fraction nor a quoted number is taken for one, and it is left out.

    A reply is parsed once: a plain list by a typed reader, straight into these columns, any
    other as a VARIANT, which also tells lists with text behind them or a repeated key.
    """
    missing = lambda job_id, status: job_id.isNull() | status.isNull()

    def entry(job_id: Column, status: Column, error: Column) -> Column:
        return F.struct(job_id.alias("job_id"), status.alias("status"), error.alias("error"))

    def plain(job: Column) -> Column:
        absent = F.when(missing(job["jobId"], job["status"]), "missing_path")
        return entry(job["jobId"], job["status"], absent)

    def other(job: Column) -> Column:
        job_id, status = (F.try_variant_get(job, path, "variant") for path in ("$.jobId", "$.status"))
        whole = F.schema_of_variant(job_id) == "BIGINT"
        error = F.when(missing(job_id, status), "missing_path").when(~whole, "bad_job_id")
        return entry(
            F.when(whole, F.try_variant_get(job_id, "$", "bigint")), F.try_variant_get(status, "$", "string"), error
        )

    typed = F.from_json(F.col(body), "array<struct<jobId: bigint, status: string>>")
    is_plain = F.coalesce(F.col(body).rlike(PLAIN_JOBS), F.lit(False))
    made = df.withColumn("_plain", F.when(is_plain, typed)).withColumn(
        "_other", F.when(F.col("_plain").isNull(), F.col(body))
    )
    made = with_parsed(made, "_other", "[", "]")
    jobs = F.coalesce(
        F.transform("_plain", plain),
        F.transform(F.try_variant_get(F.col("_parsed"), "$[0]", "array<variant>"), other),
    )
    return made.withColumn(name, jobs).drop("_plain", "_other", "_parsed")


def explode_jobs(df: DataFrame, body: str) -> DataFrame:
    """One row per job of a JSON job list: `job_pos`, `job_id`, `status`, `error`.

    An empty list gives no row, a body that is not a list one `malformed` row; the errors of
    entries are those of `shredded_jobs`.
    """
    # Outer, with empty lists dropped after it: a plain explode would have Spark
    # check for empty lists ahead of it, which means parsing each body again.
    return (
        shredded_jobs(df, body, "_jobs")
        .select(
            *df.columns,
            F.col("_jobs").isNull().alias("_bad"),
            F.posexplode_outer("_jobs").alias("job_pos", "_job"),
        )
        .filter("_bad OR job_pos IS NOT NULL")
        .select(
            *df.columns,
            "job_pos",
            "_job.job_id",
            "_job.status",
            F.when(F.col("_bad"), "malformed").otherwise(F.col("_job.error")).alias("error"),
        )
    )


# API names of a batch submission record by column name.
BATCH_FIELDS = {
    "file": "file",
    "proxy_user": "proxyUser",
    "class_name": "className",
    "arguments": "args",
    "jars": "jars",
    "py_files": "pyFiles",
    "files": "files",
    "driver_memory": "driverMemory",
    "driver_cores": "driverCores",
    "executor_memory": "executorMemory",
    "executor_cores": "executorCores",
    "num_executors": "numExecutors",
    "archives": "archives",
    "queue": "queue",
    "name": "name",
    "conf": "conf",
}
# API names of a session record by column name.
SESSION_FIELDS = {
    "kind": "kind",
    "proxy_user": "proxyUser",
    "jars": "jars",
    "py_files": "pyFiles",
    "files": "files",
    "driver_memory": "driverMemory",
    "driver_cores": "driverCores",
    "executor_memory": "executorMemory",
    "executor_cores": "executorCores",
    "num_executors": "numExecutors",
    "archives": "archives",
    "yarn_queue": "queue",
    "name": "name",
    "conf": "conf",
    "heartbeat_timeout": "heartbeatTimeoutInSecond",
}


def _null_if_empty(field: T.StructField) -> Column:
    col = F.col(field.name) if "." not in field.name else F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.when(F.size(col) > 0, col)
    if isinstance(kind, T.StringType):
        return F.nullif(col, F.lit(""))
    if isinstance(kind, T.BooleanType):
        return F.when(col, col)
    if isinstance(kind, T.NumericType):
        return F.when(col != 0, col)
    return col


def compact_json(df: DataFrame, mapping: dict[str, str], name: str = "payload") -> DataFrame:
    """Add a JSON record of the mapped columns under their API names.

    Every empty field is left out: NULL, "", 0, false, [] and {}. Mapped columns
    that `df` lacks are left out too.
    """
    present = [(df.schema[column], api) for column, api in mapping.items() if column in df.columns]
    record = F.struct(*[_null_if_empty(field).alias(api) for field, api in present])
    return df.withColumn(name, F.to_json(record, {"ignoreNullFields": "true"}))
