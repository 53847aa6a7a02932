"""The logical run-history tables, expressed over the given parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions.text import quote_name
from runlens.session import remove_at_end, scratch_path
from runlens.sources.delimited import write_delimited

# Rows of one log page where whole logs are short.
SHORT_PAGE = 10

# Rows in a file of a stream's micro-batch, about.
FILE_ROWS = 5000

# Written and read with all digits, so that text keeps the exact time.
NTZ_FORMAT = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

_staged: dict[tuple, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged_text(
    spark: SparkSession, sf_dir: str, name: str, df: DataFrame, sep: str, header: bool
) -> str:
    """Path of `df` as delimited text, written once per application and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name, sep, header)
    if key not in _staged:
        path = scratch_path(spark, f"text-{name}")
        write_delimited(df, path, sep, header, **NTZ_FORMAT)
        remove_at_end(spark, path)
        _staged[key] = path
    return _staged[key]


def ddl_of(df: DataFrame) -> str:
    return ", ".join(f"{quote_name(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)


def damaged_customers(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Customers as comma-separated text, three lines of ten damaged, and their schema.

    Some lack their last fields, some have one more, some a word where a number belongs.
    """
    customer = table(spark, sf_dir, "customer")
    kind, key = F.col("c_custkey") % 10, F.col("c_custkey").cast("string")
    balance, nation = F.col("c_acctbal").cast("string"), F.col("c_nationkey").cast("string")
    whole = F.concat_ws(",", key, "c_name", nation, balance, "c_mktsegment")
    line = (
        F.when(kind == 1, F.concat_ws(",", key, "c_name", nation))
        .when(kind == 2, F.concat_ws(",", whole, F.lit("more")))
        .when(kind == 3, F.concat_ws(",", key, "c_name", F.lit("none"), balance, "c_mktsegment"))
        .when(kind == 4, F.concat_ws(",", key, F.lit(""), nation, F.lit(""), "c_mktsegment"))
        .otherwise(whole)
    )
    name = (spark.sparkContext.applicationId, sf_dir, "damaged customers")
    if name not in _staged:
        path = scratch_path(spark, "text-damaged")
        customer.select(line).write.text(path)
        remove_at_end(spark, path)
        _staged[name] = path
    return _staged[name], ddl_of(customer)


def event_state(event_type: Column | str = "event_type") -> Column:
    """Events read as states a run was seen in."""
    kind = F.col(event_type) if isinstance(event_type, str) else event_type
    return (
        F.when(kind.isin("view", "click"), "running")
        .when(kind == "signup", "starting")
        .when(kind == "purchase", "success")
        .otherwise(kind)
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per user; a driver log link is known only on some observations."""
    link = F.when(F.col("event_type") == "click", F.concat(F.lit("http://logs/"), "event_id"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("run_id"),
        "ts",
        event_state().alias("state"),
        F.struct(F.coalesce(link, F.lit("")).alias("driver_log_url")).alias("app_info"),
    )


def observation_stream(spark: SparkSession, sf_dir: str, batches: int = 4) -> DataFrame:
    """The same observations as a stream of `batches` micro-batches, in order of time."""
    events = table(spark, sf_dir, "events")
    parts = [(i + 1) / batches for i in range(batches - 1)]
    n, cuts = events.agg(F.count(F.lit(1)), F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), parts)).first()
    # Files of a micro-batch: as many as there are tasks, if none is left empty.
    files = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), n // (batches * FILE_ROWS)))
    path = scratch_path(spark, "observations")
    remove_at_end(spark, path)
    observed = events.select(
        "event_id",
        F.col("user_id").alias("run_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        event_state().alias("state"),
    )
    at = F.unix_micros("ts")
    for low, high in zip([None, *(cuts or [])], [*(cuts or []), None]):
        part = observed
        if low is not None:
            part = part.filter(at > low)
        if high is not None:
            part = part.filter(at <= high)
        part.repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(observed.schema).option("maxFilesPerTrigger", files).parquet(path)


def run_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, start_ts): users start with their first event, customers without any with the first of all."""
    events = table(spark, sf_dir, "events")
    known = events.select(F.col("user_id").alias("run_id"), "ts").unionByName(
        table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("run_id")), allowMissingColumns=True
    )
    seen = known.filter("run_id IS NOT NULL").groupBy("run_id").agg(F.min("ts").alias("seen_ts"))
    first = events.agg(F.min("ts").alias("first_ts"))
    return seen.join(F.broadcast(first)).select("run_id", F.coalesce("seen_ts", "first_ts").alias("start_ts"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per order; not every run has an application id or a verifier."""
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    priority = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        F.when(priority != "4-NOT SPECIFIED", F.col("o_orderkey")).alias("app_id"),
        F.when(status == "F", "success").when(status == "O", "running").otherwise("error").alias("state"),
        F.when(price >= 325000, "yarn").when(price >= 150000, "spark").alias("verify_in"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), True)
        .when(priority.isin("3-MEDIUM", "5-LOW"), False)
        .alias("spill_logs"),
    )


def app_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job per order line; some orders have none."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("app_id"),
        F.col("l_linenumber").alias("ord"),
        F.col("l_partkey").alias("job_id"),
        F.when(F.col("l_returnflag") == "R", "FAILED").otherwise("SUCCEEDED").alias("status"),
    )


def app_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final status per application from its lines; none for orders without lines."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("app_id"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.bool_and(F.col("l_linestatus") == "O").alias("all_open"),
        )
        .select(
            "app_id",
            F.when(F.col("all_open"), "UNDEFINED")
            .when(F.col("n") >= 7, "KILLED")
            .otherwise("SUCCEEDED")
            .alias("final_status"),
        )
    )


def run_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log row per order line."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("run_id"),
        F.col("l_linenumber").alias("pos"),
        F.col("l_partkey").alias("part"),
        F.concat_ws(" ", "l_returnflag", "l_linestatus", F.col("l_suppkey").cast("string")).alias("line"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies made from event properties, most kinds of event damaged in one way.

    Some hold a second value, or more members, behind the first.
    """
    kind, props = F.col("event_type"), F.col("props")
    state = F.concat(
        F.lit('{"id": '), F.col("event_id"), F.lit(', "state": "running", "appId": null, "props": '),
        props, F.lit("}"),
    )
    quoted = F.concat(
        F.lit('{"id": "'), F.col("event_id"), F.lit('", "state": null, "output": {"status": "ok"}}')
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("run_id"),
        "ts",
        F.when(kind == "click", state)
        .when(kind == "signup", quoted)
        .when(kind == "purchase", F.concat(F.lit("["), props, F.lit("]")))
        .when((kind == "error") & (F.col("event_id") % 3 == 0), F.concat(props, F.lit("}")))
        .when((kind == "error") & (F.col("event_id") % 3 == 1), F.concat(props, F.lit(',"x":'), props))
        .when(kind == "error", F.concat(props, F.lit("],[0,"), props))
        .otherwise(props)
        .alias("body"),
    )


def job_list_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job lists of up to two jobs: some cut short, no list, incomplete, with text behind, or without a proper id."""
    flag = F.col("l_returnflag")
    first = F.concat(F.lit('{"jobId": '), F.col("l_linenumber"), F.lit(', "status": "SUCCEEDED"}'))
    number = F.col("l_linenumber")
    job_id = F.when(number == 7, '"7"').when(number == 6, "6.5").otherwise(F.col("l_partkey").cast("string"))
    second = F.concat(F.lit('{"jobId": '), job_id, F.lit(', "status": "FAILED"}'))
    nameless = F.lit('{"status": "SUCCEEDED"}')
    both = F.concat(F.lit("["), first, F.lit(", "), second, F.lit("]"))
    status = F.col("l_linestatus")
    body = (
        F.when((flag == "A") & (status == "O"), both)
        .when((flag == "A") & (status == "F"), F.concat(F.lit("["), first, F.lit("]")))
        .when((flag == "N") & (status == "O"), F.concat(F.lit("["), first, F.lit(", "), nameless, F.lit("]")))
        .when((flag == "N") & (status == "F"), F.lit("[]"))
        .when((flag == "R") & (status == "O"), first)
        .when(F.col("l_suppkey") % 2 == 0, F.concat(F.lit("["), first, F.lit(",")))
        .otherwise(F.concat(F.lit("["), first, F.lit('],"x":['), second, F.lit("]")))
    )
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", body.alias("body"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per document, one log line per line of its text."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.col("doc_id").alias("run_id"),
        F.posexplode(F.split("text", "\n")).alias("pos", "line"),
    )


def log_pages(spark: SparkSession, sf_dir: str, size: int) -> DataFrame:
    """Pages of the same logs, with the language."""
    docs = table(spark, sf_dir, "documents")
    lines = docs.select(
        F.col("doc_id").alias("run_id"), "lang", F.split("text", "\n").alias("lines")
    ).withColumn("n", F.size("lines"))
    pages = lines.select(
        "run_id",
        "lang",
        "n",
        "lines",
        F.explode(F.expr(f"sequence(0, n - 1, {size})")).alias("from"),
    )
    return pages.select(
        "run_id",
        "lang",
        F.col("from").cast("bigint").alias("from"),
        F.col("n").cast("bigint").alias("total"),
        F.slice("lines", F.col("from") + 1, F.lit(size)).alias("log"),
    )


def damaged_pages(pages: DataFrame, size: int) -> DataFrame:
    """The pages, and copies of them as runs of their own (-1 - run_id) that are damaged.

    Of the copies some languages lack totals or lines on later pages, some the second
    page, and English ones have every page twice.
    """
    lang, late = F.col("lang"), F.col("from") > 0
    copies = pages.filter(~((lang == "es") & (F.col("from") == size))).select(
        (-1 - F.col("run_id")).alias("run_id"),
        "lang",
        "from",
        F.when(~((lang == "de") & late), F.col("total")).alias("total"),
        F.when((lang == "fr") & late, F.array().cast("array<string>")).otherwise(F.col("log")).alias("log"),
    )
    return pages.unionByName(copies).unionByName(copies.filter(lang == "en"))


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session per conversation, one statement per turn."""
    size = F.length("text")
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("session_id"),
        F.col("turn").alias("pos"),
        F.when(F.col("role") == "system", "waiting").otherwise("available").alias("state"),
        F.when(size < 700, "ok").when(size < 1500, "error").alias("status"),
    )


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run settings from part attributes, right and wrong ones."""
    kind, size = F.col("p_type"), F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.when(kind == "MEDIUM", "spark")
        .when(kind == "STANDARD", "pyspark")
        .when(kind == "LARGE", "sparkr")
        .when(kind == "SMALL", "sql")
        .when(kind == "PROMO", "scala")
        .alias("kind"),
        F.when(size <= 15, "spark").when(size <= 30, "yarn").when(size <= 35, "mesos").alias("verify_in"),
        (size - 3).alias("poke_interval"),
        (F.length("p_name") * 2).alias("timeout"),
    )


def batch_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submission records of all fields, some of them empty."""
    size = F.col("p_size")
    name = F.lower("p_brand")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("file"),
        F.when(F.col("p_type") == "PROMO", "").otherwise(F.col("p_type")).alias("class_name"),
        F.when(size > 25, F.split("p_name", " ")).otherwise(F.array().cast("array<string>")).alias("arguments"),
        F.when(size % 2 == 0, F.concat(F.lit("user-"), size)).alias("proxy_user"),
        F.when(size % 3 == 0, F.array(F.concat(name, F.lit(".jar")))).alias("jars"),
        F.when(size % 5 == 0, F.array(F.concat(name, F.lit(".py")))).alias("py_files"),
        F.when(size % 7 == 0, F.array(F.concat(name, F.lit(".txt")))).alias("files"),
        F.when(size % 11 == 0, F.array(F.concat(name, F.lit(".zip")))).alias("archives"),
        F.when(size > 30, F.concat(size, F.lit("g"))).otherwise(F.lit("")).alias("driver_memory"),
        F.greatest(F.lit(0), size - 20).alias("driver_cores"),
        F.greatest(F.lit(0), size - 30).alias("executor_cores"),
        F.greatest(F.lit(0), size - 40).alias("num_executors"),
        F.when(size % 4 == 0, F.concat(F.lit("part "), F.col("p_partkey"))).alias("name"),
        F.when(size <= 10, F.concat(size.cast("string"), F.lit("g"))).alias("executor_memory"),
        F.lower("p_brand").alias("queue"),
        F.when(size > 40, F.create_map(F.lit("spark.app.size"), size.cast("string")))
        .otherwise(F.create_map().cast("map<string,string>"))
        .alias("conf"),
    )


def session_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session records from suppliers, some fields empty."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("id"),
        F.when(key % 2 == 0, "sql").otherwise("spark").alias("kind"),
        F.when(key % 3 == 0, "").otherwise(F.col("s_name")).alias("proxy_user"),
        F.when(key % 4 == 0, F.array(F.lit("a.jar"), F.lit("b.jar"))).alias("jars"),
        F.when(key % 5 == 0, F.array(F.lit("a.py"))).otherwise(F.array().cast("array<string>")).alias("py_files"),
        F.when(key % 6 == 0, F.array(F.lit("a.txt"))).alias("files"),
        F.when(key % 7 == 0, F.lit("2g")).alias("driver_memory"),
        (key % 8).alias("driver_cores"),
        F.when(key % 9 == 0, F.lit("3g")).alias("executor_memory"),
        (key % 10).alias("executor_cores"),
        nation.alias("num_executors"),
        F.when(key % 11 == 0, F.array(F.lit("a.zip"))).alias("archives"),
        F.when(key % 12 == 0, F.lit("nightly")).alias("yarn_queue"),
        F.when(key % 13 == 0, F.lit("probe")).alias("name"),
        F.when(key % 14 == 0, F.create_map(F.lit("spark.app.key"), key.cast("string"))).alias("conf"),
        F.when(key % 15 == 0, key).alias("heartbeat_timeout"),
    )


def session_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as states a session was seen in while it started."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("run_id"),
        "ts",
        F.when(kind.isin("view", "click", "signup"), "starting").when(kind == "purchase", "idle").otherwise(kind).alias("state"),
    )


def statement_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies about statements, one statement per user; some without a status, or with a null one."""
    kind = F.col("event_type")
    body = (
        F.when(kind == "view", '{"state": "waiting"}')
        .when(kind == "click", '{"state": "running", "output": null}')
        .when(kind == "signup", '{"state": "available", "output": {"status": "ok"}}')
        .when((kind == "purchase") & (F.col("event_id") % 2 == 0), '{"state": "available", "output": {}}')
        .when(kind == "purchase", '{"state": "available", "output": {"status": null}}')
        .otherwise('{"state": "available", "output": {"status": "error"}')
    )
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("run_id"), "ts", body.alias("body")
    )
