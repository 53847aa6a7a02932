"""One query per operator, each over whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions.replies import (
    BATCH_FIELDS,
    SESSION_FIELDS,
    compact_json,
    explode_jobs,
    numeric_id,
    parse_replies,
    statement_states,
)
from runlens.functions.states import (
    SESSION,
    STATEMENT_REPLY,
    classify_batch,
    classify_session,
    classify_statement,
)
from runlens.functions.text import path_safe, tag_text
from runlens.operators import history, logs, outcome, scripts, verify
from runlens.operators.join_files import FileInput, JoinJob, join_two_files, preview
from runlens.operators.skew import HotKeys
from runlens.operators.validate import split_valid, validate
from runlens.plans import tables
from runlens.plans.sql import run_script, run_sql
from runlens.plans.tables import NTZ_FORMAT, ddl_of, staged_text, table
from runlens.session import remove_at_end, scratch_path
from runlens.sources.delimited import good_rows, read_checked, read_delimited, register, write_delimited
from runlens.sources.mounts import mount
from runlens.sources.rows import id_range, literal_column, literal_rows
from runlens.streaming.outcome import (
    drain,
    first_terminal_stream,
    run_outcome_stream,
    with_rocksdb,
)

# Timings of the runs made from events, which lie hours apart.
RUN_TIMEOUT_SEC = 12 * 3600
SAMPLE_PERIOD_SEC = 6 * 3600
SAMPLE_TIMEOUT_SEC = 10 * 24 * 3600
# Lines of a run that are numbered in one task, low enough for small tables to have more.
NUMBERED_ROWS = 1000
# Users are silent for weeks, and come back as the runs that they were.
STREAM_KEEP_SEC = 40 * 24 * 3600


# --- delimited files -------------------------------------------------------


def _customer_text(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    customer = table(spark, sf_dir, "customer")
    return staged_text(spark, sf_dir, "customer", customer, ",", True), ddl_of(customer)


def _orders_text(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    orders = table(spark, sf_dir, "orders")
    return staged_text(spark, sf_dir, "orders", orders, "\t", False), ddl_of(orders)


def _nation_text(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    nation = table(spark, sf_dir, "nation")
    return staged_text(spark, sf_dir, "nation", nation, "\t", False), ddl_of(nation)


def scan_csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, schema = _customer_text(spark, sf_dir)
    return read_delimited(spark, path, schema, header=True, sep=",")


def scan_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _orders_text(spark, sf_dir)
    # Inferred times have a zone; the session's is UTC.
    found = read_delimited(spark, path, infer_schema=True, header="", quote=None)
    return found.withColumn("_c4", F.col("_c4").cast("timestamp_ntz"))


def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = _scratch(spark, "roundtrip")
    write_delimited(orders, None)
    write_delimited(orders, path, header=True, **NTZ_FORMAT)
    return read_delimited(spark, path, ddl_of(orders), header=True, **NTZ_FORMAT)


def sink_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = _scratch(spark, "append")
    write_delimited(orders, path, **NTZ_FORMAT)
    write_delimited(orders, path, mode="append", **NTZ_FORMAT)
    both = read_delimited(spark, path, ddl_of(orders), header=False, **NTZ_FORMAT)
    return both.groupBy(*orders.columns).agg(F.count(F.lit(1)).alias("n"))


def sink_ignore_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = _scratch(spark, "ignore")
    write_delimited(orders, path, **NTZ_FORMAT)
    write_delimited(orders.withColumn("o_orderstatus", F.lit("X")), path, mode="ignore", **NTZ_FORMAT)
    return read_delimited(spark, path, ddl_of(orders), header=False, **NTZ_FORMAT)


def scan_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as text, some lines short, long or with a word for a number: counts by reason."""
    path, schema = tables.damaged_customers(spark, sf_dir)
    checked = read_checked(spark, path, schema, sep=",")
    return checked.groupBy(F.col("_reason").alias("reason"), F.col("_column").alias("column")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("c_custkey").alias("keys"),
        F.min("_record").alias("example"),
    )


def scan_good_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, schema = tables.damaged_customers(spark, sf_dir)
    return good_rows(read_checked(spark, path, schema, sep=","))


def sink_mounted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out to one file system and back in through another scheme, and the other way round."""
    orders, store = table(spark, sf_dir, "orders"), _scratch(spark, "store")
    for folder in ("in", "out"):
        write_delimited(orders.limit(0), f"{store}/{folder}/empty")
    root = mount(spark, store.rsplit("-", 1)[1], {"orders/in": f"{store}/in", "joined": f"{store}/out"})
    write_delimited(orders, f"{store}/in/plain", header=True, **NTZ_FORMAT)
    schema = ddl_of(orders)
    seen = read_delimited(spark, f"{root}/orders/in/plain", schema, header=True, **NTZ_FORMAT)
    write_delimited(seen, f"{root}/joined/copy", **NTZ_FORMAT)
    write_delimited(seen.filter("o_orderstatus = 'F'"), f"{root}/joined/copy", mode="append", **NTZ_FORMAT)
    copies = read_delimited(spark, f"{store}/out/copy", schema, **NTZ_FORMAT)
    return copies.groupBy(*orders.columns).agg(F.count(F.lit(1)).alias("n"))


def _scratch(spark: SparkSession, name: str) -> str:
    path = scratch_path(spark, name)
    remove_at_end(spark, path)
    return path


# --- joins of delimited files ----------------------------------------------


def join_two_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, customer_ddl = _customer_text(spark, sf_dir)
    nation, nation_ddl = _nation_text(spark, sf_dir)
    return JoinJob(
        FileInput(customer, "c_nationkey", customer_ddl, header=True, sep=","),
        FileInput(nation, "n_nationkey", nation_ddl, header=False),
        ["file1.c_custkey", "file1.c_name", "file2.n_name"],
    ).run(spark)


def join_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, _ = _customer_text(spark, sf_dir)
    nation, _ = _nation_text(spark, sf_dir)
    job = JoinJob(
        FileInput(
            customer,
            "Nation key",
            "`Customer key` BIGINT, `Full name` STRING, `Nation key` INT, balance DOUBLE, segment STRING",
            header="true",
            sep=",",
        ),
        FileInput(nation, "key", "key INT, `Nation name` STRING, region INT", header="false"),
        "file1.`Customer key` AS id, file1.`Full name` AS full_name, "
        "concat(file2.`Nation name`, ', ', file1.segment) AS place",
    )
    return job.run(spark)


def join_diff_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, orders_ddl = _orders_text(spark, sf_dir)
    customer, customer_ddl = _customer_text(spark, sf_dir)
    return JoinJob(
        FileInput(orders, "o_custkey", orders_ddl, header=False),
        FileInput(customer, "c_custkey", customer_ddl, header=True, sep=","),
        ["file1.o_orderkey", "file2.c_name", "file2.c_mktsegment AS segment"],
    ).run(spark)


def join_dup_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority, segment = F.col("o_orderpriority"), F.col("c_mktsegment")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(priority != "4-NOT SPECIFIED", F.col("o_custkey")).alias("o_custkey")
    )
    customer = table(spark, sf_dir, "customer").select(
        F.when(segment != "HOUSEHOLD", F.col("c_custkey")).alias("c_custkey"), "c_mktsegment"
    )
    twice = customer.withColumn("copy", F.lit("a")).unionByName(customer.withColumn("copy", F.lit("b")))
    left = staged_text(spark, sf_dir, "orders-null-keys", orders, "\t", False)
    right = staged_text(spark, sf_dir, "customer-twice", twice, "\t", False)
    return join_two_files(
        read_delimited(spark, left, ddl_of(orders), header=False),
        read_delimited(spark, right, ddl_of(twice), header=False),
        "o_custkey",
        "c_custkey",
        ["file1.o_orderkey", "file1.o_custkey", "file2.copy"],
    )


def join_mixed_key_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    customer = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("no-"), key))
        .otherwise(key)
        .alias("c_custkey"),
        "c_name",
    )
    right = staged_text(spark, sf_dir, "customer-text-keys", customer, "\t", False)
    left, _ = _orders_text(spark, sf_dir)
    return join_two_files(
        read_delimited(spark, left, infer_schema=True),
        read_delimited(spark, right, ddl_of(customer)),
        "_c1",
        "c_custkey",
        ["file1._c0 AS o_orderkey", "file2.c_name"],
        key_type="BIGINT",
    )


def preview_top50(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, orders_ddl = _orders_text(spark, sf_dir)
    customer, customer_ddl = _customer_text(spark, sf_dir)
    joined = join_two_files(
        read_delimited(spark, orders, orders_ddl, header=False),
        read_delimited(spark, customer, customer_ddl, header=True, sep=","),
        "o_custkey",
        "c_custkey",
        ["file1.o_orderkey", "file1.o_totalprice", "file2.c_name"],
    )
    return preview(joined, order_by=[F.desc("o_totalprice"), F.asc("o_orderkey")])


# --- literals, ranges, SQL text --------------------------------------------


def range_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    ids = id_range(spark, keys[0], keys[1] + 1)
    with_lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id")).distinct()
    return ids.join(with_lines.withColumn("has_lines", F.lit(True)), "id", "left").agg(
        F.count(F.lit(1)).alias("n_ids"),
        F.count_if(F.col("has_lines").isNull()).alias("n_without_lines"),
    )


def literal_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = literal_rows(
        spark, [("finished", "F"), ("open", "O"), ("partial", "P")], ["label", "run:1"], ["STRING", "STRING"]
    )
    orders = table(spark, sf_dir, "orders")
    return (
        orders.join(labels, orders["o_orderstatus"] == labels["`run:1`"])
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )


def literal_column_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = literal_column(spark, ["click", "purchase", "refund"], "event_type")
    return (
        table(spark, sf_dir, "events")
        .join(wanted.withColumn("wanted", F.lit(True)), "event_type", "left")
        .groupBy("event_type", F.col("wanted").isNotNull().alias("wanted"))
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


def select_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(table(spark, sf_dir, "orders"), "orders")
    return run_sql(
        spark,
        "SELECT o_orderstatus, (SELECT 'orders by status') AS note, count(*) AS n_orders "
        "FROM orders GROUP BY o_orderstatus",
    )


def sql_over_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(table(spark, sf_dir, "customer"), "customer")
    register(table(spark, sf_dir, "orders"), "orders")
    return run_sql(
        spark,
        "SELECT c_mktsegment, o_orderstatus, count(*) AS n_orders "
        "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment, o_orderstatus",
    )


def sql_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(table(spark, sf_dir, "orders"), "orders")
    return run_sql(
        spark,
        "SELECT IDENTIFIER(:group_by) AS grp, :label AS label, :note AS note, count(*) AS n_orders "
        "FROM IDENTIFIER(:source) WHERE o_totalprice >= :floor GROUP BY IDENTIFIER(:group_by)",
        args={"source": "orders", "group_by": "o_orderpriority", "floor": 250000, "label": ""},
        defaults={"label": "it's \"quoted\""},
        optional=("note",),
    )


def sql_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(table(spark, sf_dir, "orders"), "orders")
    register(table(spark, sf_dir, "customer"), "customer")
    run = run_script(
        spark,
        [
            "CREATE OR REPLACE TEMPORARY VIEW orders_per_customer AS "
            "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey",
            "CREATE OR REPLACE TEMPORARY VIEW customer_activity AS "
            "SELECT c_mktsegment, n FROM customer LEFT JOIN orders_per_customer ON c_custkey = o_custkey",
            "SELECT c_mktsegment, count(*) AS n_customers, count(n) AS n_active, "
            "sum(n) AS n_orders FROM customer_activity GROUP BY c_mktsegment",
        ],
        execute=False,
    )
    return run.last


def concat_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(table(spark, sf_dir, "customer"), "customer")
    return run_sql(
        spark,
        "SELECT c_custkey, CONCAT(c_name, :gap, c_mktsegment, :unit, c_nationkey) AS label FROM customer",
        args={"gap": " buys ", "unit": " #"},
    )


def path_safe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", path_safe("url").alias("path"))


def script_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of a script whose third statement names a column that isn't there."""
    register(table(spark, sf_dir, "orders"), "orders")
    run = run_script(
        spark,
        [
            "SELECT count(*) AS n FROM orders",
            "SELECT o_orderstatus, max(o_totalprice) AS top FROM orders GROUP BY o_orderstatus",
            "SELECT o_orderkey, no_such_column FROM orders",
            "SELECT min(o_orderdate) AS first FROM orders",
        ],
    )
    sizes = [(pos, result.count()) for pos, result in enumerate(run.results)]
    return run.status.join(spark.createDataFrame(sizes, "pos INT, n_rows BIGINT"), "pos", "left")


# --- classification and validation ------------------------------------------


def classify_batch_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = tables.observations(spark, sf_dir)
    return (
        obs.groupBy("state")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("state", classify_batch("state").alias("class"), "n")
    )


def classify_session_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    state = F.when(kind == "signup", "starting").when(kind == "purchase", "idle").otherwise(kind)
    return table(spark, sf_dir, "events").select(
        "event_id", state.alias("state"), classify_session(state).alias("class")
    )


def classify_statement_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.statements(spark, sf_dir).withColumn("class", classify_statement("state", "status"))


def validate_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(tables.submissions(spark, sf_dir))


def validate_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = split_valid(tables.submissions(spark, sf_dir))
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# --- outcomes ----------------------------------------------------------------


def first_terminal_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome.first_terminal(tables.observations(spark, sf_dir))


def run_outcome_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = tables.observations(spark, sf_dir)
    return outcome.run_outcome(obs, outcome.run_starts(obs), RUN_TIMEOUT_SEC)


def run_outcome_deadline(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs, starts = tables.observations(spark, sf_dir), tables.run_starts(spark, sf_dir)
    return outcome.run_outcome_at_deadline(obs, starts, RUN_TIMEOUT_SEC)


def polls_until_done_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome.polls_until_done(tables.observations(spark, sf_dir))


def sample_states_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = tables.observations(spark, sf_dir)
    return outcome.sample_states(obs, outcome.run_starts(obs), SAMPLE_PERIOD_SEC, SAMPLE_TIMEOUT_SEC)


def first_nonempty_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = tables.observations(spark, sf_dir)
    return outcome.first_nonempty(obs, "app_info.driver_log_url", "driver_log_url")


def session_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = tables.session_observations(spark, sf_dir)
    return outcome.run_outcome(obs, outcome.run_starts(obs), RUN_TIMEOUT_SEC, SESSION)


def statement_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of statements from replies; a reply that cannot be read ends one."""
    obs = statement_states(tables.statement_replies(spark, sf_dir), "body")
    return outcome.first_terminal(obs, STATEMENT_REPLY)


def fail_fast_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scripts.fail_fast(tables.statements(spark, sf_dir)).select("session_id", "pos", "run_class")


def script_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scripts.script_summary(tables.statements(spark, sf_dir))


# --- reconciliation ----------------------------------------------------------


def verify_jobs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = tables.runs(spark, sf_dir).select("run_id", "app_id")
    return verify.verify_jobs(runs, tables.app_jobs(spark, sf_dir))


def verify_final_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = tables.runs(spark, sf_dir).select("run_id", "app_id")
    return verify.verify_final(runs, tables.app_final(spark, sf_dir))


def _reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.reconcile(
        tables.runs(spark, sf_dir), tables.app_jobs(spark, sf_dir), tables.app_final(spark, sf_dir)
    )


def reconcile_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reconciled(spark, sf_dir).select("run_id", "outcome", "reason", "bad_status")


def disagreement_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.disagreements(_reconciled(spark, sf_dir))


def _own_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.runs(spark, sf_dir).withColumn("outcome", classify_batch("state"))


def select_logs_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    log_rows = tables.run_logs(spark, sf_dir)
    return verify.select_logs(_own_outcomes(spark, sf_dir), log_rows)


def dropped_logs_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    log_rows = tables.run_logs(spark, sf_dir)
    return verify.select_logs(_own_outcomes(spark, sf_dir), log_rows, kept=False)


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconciled outcomes with the number of log lines to keep for them."""
    per_run = (
        tables.run_logs(spark, sf_dir).groupBy("run_id").agg(F.count(F.lit(1)).alias("n_lines"))
    )
    kept_lines = F.when(verify.wants_logs(), F.col("n_lines"))
    return (
        _reconciled(spark, sf_dir)
        .join(per_run, "run_id", "left")
        .groupBy("outcome", "reason")
        .agg(
            F.count(F.lit(1)).alias("n_runs"),
            F.coalesce(F.sum(kept_lines), F.lit(0)).alias("n_log_lines"),
        )
    )


# --- replies -----------------------------------------------------------------


def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {"id": ("$.id", "string"), "state": ("$.state", "string"), "k": ("$.props.k", "bigint")}
    replies = tables.responses(spark, sf_dir).select("event_id", "body")
    return parse_replies(replies, "body", fields).drop("body")


def json_error_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {"state": ("$.state", "string"), "status": ("$.output.status", "string")}
    parsed = parse_replies(tables.responses(spark, sf_dir), "body", fields)
    return parsed.groupBy("error", "missing_path", "status").agg(F.count(F.lit(1)).alias("n"))


def json_numeric_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numeric_id(tables.responses(spark, sf_dir).select("event_id", "body"), "body").drop("body")


def reply_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies to run outcomes: a run also ends with a reply that cannot be read."""
    parsed = parse_replies(
        tables.responses(spark, sf_dir), "body", {"reported": ("$.state", "string")}
    )
    state = F.coalesce("error", "reported").alias("state")
    return outcome.first_terminal(parsed.select("run_id", "event_id", "ts", state))


def end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From replies to kept logs: state replies and timeouts, job lists, final statuses, log lines."""
    replies = parse_replies(tables.responses(spark, sf_dir), "body", {"reported": ("$.state", "string")})
    obs = replies.select("run_id", "event_id", "ts", F.coalesce("error", "reported").alias("state"))
    lists = explode_jobs(tables.job_list_replies(spark, sf_dir), "body")
    jobs = lists.select(
        F.col("l_orderkey").alias("app_id"),
        (F.col("l_linenumber") * 2 + F.coalesce("job_pos", F.lit(0))).alias("ord"),
        "job_id",
        "status",
        "error",
    )
    runs = tables.runs(spark, sf_dir)
    return history.run_verdicts(
        runs,
        tables.run_starts(spark, sf_dir),
        obs,
        jobs,
        tables.app_final(spark, sf_dir),
        tables.run_logs(spark, sf_dir),
        RUN_TIMEOUT_SEC,
        hot_runs=HotKeys.find(tables.observations(spark, sf_dir), key="run_id"),
        hot_apps=HotKeys.find(runs, key="app_id"),
    )


def json_explode_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_jobs(tables.job_list_replies(spark, sf_dir), "body").drop("body")


def compact_json_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_json(tables.batch_settings(spark, sf_dir), BATCH_FIELDS).select("id", "payload")


def compact_session_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_json(tables.session_settings(spark, sf_dir), SESSION_FIELDS).select("id", "payload")


# --- logs and pages ----------------------------------------------------------


def paginate_lines_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = logs.paginate_lines(tables.log_lines(spark, sf_dir), tables.SHORT_PAGE)
    return pages.select(
        "run_id", "from", F.size("log").alias("n_lines"), F.array_join("log", "\n").alias("log_text")
    )


def paginate_full_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = logs.paginate_lines(tables.log_lines(spark, sf_dir))
    return pages.select(
        "run_id", "from", F.size("log").alias("n_lines"), F.array_join("log", "\n").alias("log_text")
    )


def page_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetches per document, at a short page."""
    return logs.page_counts(tables.log_lines(spark, sf_dir), size=tables.SHORT_PAGE)


def page_counts_empty_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetches per order at full pages; some orders have no line, and so an empty log."""
    runs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"))
    return logs.page_counts(tables.run_logs(spark, sf_dir), runs)


def assemble_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.assemble_pages(tables.log_pages(spark, sf_dir, logs.PAGE_LINES))


def log_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole logs are complete; damaged copies of them show every other status."""
    pages = tables.log_pages(spark, sf_dir, tables.SHORT_PAGE)
    return logs.page_status(tables.damaged_pages(pages, tables.SHORT_PAGE))


def unescape_lines_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    escaped = table(spark, sf_dir, "documents").select(
        "doc_id", F.replace("text", F.lit("\n"), F.lit("\\n")).alias("text")
    )
    return logs.unescape_lines(escaped, "text", ["doc_id"])


def html_tag_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id",
        tag_text("html", "title").alias("title"),
        tag_text("html", "p").alias("last_p"),
        tag_text("html", "h1").alias("heading"),
    )


def html_raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with headings in scripts, styles, comments and CDATA sections around them, which are none."""
    html = F.concat(
        F.lit("<SCRIPT type='a>b'>var a = \"<pre>no</pre>\";</SCRIPT><!-- <h1>no</h1> -->"),
        "html",
        F.lit("<style><p>no</p></style><![CDATA[<h1>no</h1>]]><!-- <pre>no</pre> --><!x <h1>"),
        F.lit('<script>a < "<h1>no</h1>" &amp;</script><style/>'),
    )
    return table(spark, sf_dir, "pages").select(
        "page_id",
        tag_text(html, "h1").alias("heading"),
        tag_text(html, "script").alias("script"),
        tag_text(html, "style").alias("style"),
        tag_text(html, "pre").alias("pre"),
    )


def paginate_unnumbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in order of time; one run has a third of them, and is cut into ranges where that is many."""
    event_id = F.col("event_id")
    lines = table(spark, sf_dir, "events").select(
        F.when(event_id % 3 == 0, 0).otherwise(F.col("user_id")).alias("run_id"),
        "ts",
        "event_id",
        F.concat_ws(" ", "event_type", event_id.cast("string")).alias("line"),
    )
    pages = logs.paginate(lines, ["run_id"], ["ts", "event_id"], min_hot_rows=NUMBERED_ROWS)
    return pages.select(
        "run_id", "from", F.size("log").alias("n_lines"), F.array_join("log", "\n").alias("log_text")
    )


# --- streams -----------------------------------------------------------------


def stream_first_terminal(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = first_terminal_stream(tables.observation_stream(spark, sf_dir), keep_sec=STREAM_KEEP_SEC)
    with with_rocksdb(spark):
        updates = drain(decided, "update", "first-terminal")
    row = F.max_by(F.struct("outcome", "state", "decided_ts", "event_id"), "batch_id").alias("r")
    return (
        updates.groupBy("run_id")
        .agg(row)
        .select("run_id", "r.outcome", "r.state", F.col("r.decided_ts").cast("timestamp_ntz").alias("decided_ts"), "r.event_id")
    )


def stream_run_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four micro-batches; some runs are never seen, all starts are known from the first on."""
    starts = tables.run_starts(spark, sf_dir).select(
        "run_id", F.col("start_ts").cast("timestamp").alias("start_ts")
    )
    path = _scratch(spark, "starts")
    starts.write.parquet(path)
    started = spark.readStream.schema(starts.schema).parquet(path)
    observed = tables.observation_stream(spark, sf_dir)
    decided = run_outcome_stream(observed, started, RUN_TIMEOUT_SEC)
    with with_rocksdb(spark):
        reported = drain(decided, "append", "run-outcome")
    return reported.select(
        "run_id", "outcome", F.col("decided_ts").cast("timestamp_ntz").alias("decided_ts"), "state"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_csv_schema": scan_csv_schema,
    "scan_csv_infer": scan_csv_infer,
    "scan_rejects": scan_rejects,
    "scan_good_rows": scan_good_rows,
    "sink_csv_roundtrip": sink_csv_roundtrip,
    "sink_append_twice": sink_append_twice,
    "sink_ignore_existing": sink_ignore_existing,
    "sink_mounted": sink_mounted,
    "join_two_files": join_two_files_query,
    "join_renamed": join_renamed,
    "join_diff_keys": join_diff_keys,
    "join_dup_null_keys": join_dup_null_keys,
    "join_mixed_key_types": join_mixed_key_types,
    "preview_top50": preview_top50,
    "range_count": range_count,
    "literal_rows": literal_rows_query,
    "literal_column": literal_column_query,
    "select_literal": select_literal,
    "sql_over_views": sql_over_views,
    "sql_params": sql_params,
    "sql_script": sql_script,
    "script_status": script_status,
    "concat_params": concat_params,
    "path_safe": path_safe_query,
    "classify_batch": classify_batch_query,
    "classify_session": classify_session_query,
    "classify_statement": classify_statement_query,
    "validate_config": validate_config,
    "validate_reason_counts": validate_reason_counts,
    "sample_states_asof": sample_states_asof,
    "first_terminal": first_terminal_query,
    "run_outcome_timeout": run_outcome_timeout,
    "run_outcome_deadline": run_outcome_deadline,
    "polls_until_done": polls_until_done_query,
    "first_nonempty": first_nonempty_query,
    "session_outcome": session_outcome,
    "statement_outcome": statement_outcome,
    "fail_fast_prefix": fail_fast_prefix,
    "script_summary": script_summary_query,
    "verify_jobs": verify_jobs_query,
    "verify_final": verify_final_query,
    "reconcile_outcome": reconcile_outcome,
    "disagreement_counts": disagreement_counts,
    "select_logs_semi": select_logs_semi,
    "dropped_logs_anti": dropped_logs_anti,
    "run_report": run_report,
    "json_extract": json_extract,
    "json_error_class": json_error_class,
    "json_numeric_id": json_numeric_id,
    "reply_outcomes": reply_outcomes,
    "end_to_end": end_to_end,
    "json_explode_jobs": json_explode_jobs,
    "compact_json": compact_json_query,
    "compact_session_json": compact_session_json,
    "paginate_lines": paginate_lines_query,
    "paginate_full_pages": paginate_full_pages,
    "paginate_unnumbered": paginate_unnumbered,
    "page_counts": page_counts_query,
    "page_counts_empty_logs": page_counts_empty_logs,
    "assemble_log_lines": assemble_log_lines,
    "log_completeness": log_completeness,
    "unescape_lines": unescape_lines_query,
    "html_tag_text": html_tag_text,
    "html_raw_text": html_raw_text,
    "stream_first_terminal": stream_first_terminal,
    "stream_run_outcome": stream_run_outcome,
}
