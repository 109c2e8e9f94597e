"""Run-tracking state: jobs, nodes, stages and the queue.

State tables are append-only logs; a table's current rows are a fold over its log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from variloom.functions.barcode import case_from_command
from variloom.functions.labels import format_epoch, human_size, node_label, progress_label
from variloom.operators.ordering import last_per_key
from variloom.session import work_path

# Job states with a counter of their own, and those that count as failed.
JOB_STATES = ["RUNNING", "PENDING", "SUSPENDED", "COMPLETING", "COMPLETED", "CANCELLED", "FAILED",
              "TIMEOUT"]
FAILED_STATES = ["FAILED", "SUSPENDED", "CANCELLED", "TIMEOUT"]

# Node states that take no jobs, texts for missing job details, final stage.
DOWN_STATES = ["DOWN", "DOWN*"]
NO_NODE, NO_SUBMIT, NO_REQUEST = "Un-assigned", "Un-submitted", "Unknown"
FINAL_STAGE = 9

# State tables, by what a reset does to them.
RUN_TABLES = ["FinishedSamples", "RunningSamples", "queued", "processing"]
METRIC_TABLES = ["MpileUp", "SamtoolsSort", "VarscanProcessIndels", "VarscanProcessSnps",
                 "VarscanSomatic"]
FINISHED_TABLE = "finished"
FAILED_TABLE = "failed"

# Job fields kept in reports, and those of them that are times.
TIME_FIELDS = ["submit_time", "start_time", "suspend_time", "end_time", "eligible_time", "resize_time"]
JOB_FIELDS = [*TIME_FIELDS, "run_time", "run_time_str", "comment", "nodes", "job_state", "command", "req_nodes"]


def project_jobs(jobs: DataFrame) -> DataFrame:
    """Jobs with their case, the reported fields and a list of requested nodes.

    Times given in epoch seconds are shown as text, 0 and NULL as ``NA``.
    """
    kinds = dict(jobs.dtypes)
    wanted = [format_epoch(F.col(c)).alias(c) if c in TIME_FIELDS and kinds[c] in ("int", "bigint") else F.col(c)
              for c in JOB_FIELDS if c in kinds]
    out = jobs.select("job_id", case_from_command(F.col("command")).alias("case_id"), *wanted)
    if kinds["req_nodes"] == "string":
        out = out.withColumn("req_nodes", F.split("req_nodes", ","))
    return out


def _state_counts() -> list[Column]:
    state = F.col("job_state")
    named = [F.count_if(state == s).alias(s.lower()) for s in JOB_STATES]
    other = F.count_if(~F.coalesce(state.isin(JOB_STATES), F.lit(False))).alias("other")
    return [*named, other, F.count_if(state.isin(FAILED_STATES)).alias("failed_total")]


def job_state_counts(jobs: DataFrame) -> DataFrame:
    """Jobs per case and state over the named states, the rest and the failed sum."""
    return project_jobs(jobs).groupBy("case_id").agg(*_state_counts())


def job_summary(jobs: DataFrame) -> DataFrame:
    """Per case: state counts, last submit time, last known node, last request."""
    return project_jobs(jobs).groupBy("case_id").agg(
        *_state_counts(),
        F.max_by(F.coalesce(F.col("submit_time").cast("string"), F.lit("NA")), "job_id").alias("submit_time"),
        F.max_by("nodes", F.when(F.col("nodes") != "", F.col("job_id"))).alias("node"),
        F.max_by(F.array_join("req_nodes", ", "), "job_id").alias("requested"),
    )


def progress(processing: DataFrame, jobs: DataFrame) -> DataFrame:
    """Samples in progress with their job summary; samples without a job are left out."""
    joined = processing.join(job_summary(jobs), "case_id")
    return joined.withColumns({
        "node": F.coalesce("node", F.lit(NO_NODE)),
        "submit_time": F.coalesce("submit_time", F.lit(NO_SUBMIT)),
        "requested": F.coalesce("requested", F.lit(NO_REQUEST)),
        "progress": progress_label(F.col("running"), F.col("pending"), F.col("failed_total")),
    })


def listings(state: DataFrame, jobs: DataFrame, limit: int = 50) -> DataFrame:
    """The dashboard's three listings and its counters, told apart by ``listing``.

    ``state`` has one row per sample: ``row_id``, ``case_id``, ``cancer_type``, ``tumor_size``, ``normal_size``,
    ``stage`` and ``state``. ``processing`` lists the samples with a job, ``queued`` the first ``limit`` by
    ``row_id``, ``finished`` all; rows of ``counts`` carry a counter's name in ``case_id`` and its value in ``n``
    (``running``, ``waiting_count``, ``finished``).

    The state is evaluated once and put down by state, so each listing reads the rows of its own state.
    """
    spark = state.sparkSession
    path = work_path(spark, "listings")
    state.write.partitionBy("state").parquet(path)
    parts = spark.read.schema(state.schema).parquet(path)
    running = progress(parts.where("state = 'processing'").select("row_id", "case_id", "cancer_type"), jobs)
    sized = [human_size(F.col(c)).alias(c) for c in ("tumor_size", "normal_size")]
    first = parts.where("state = 'queued'").orderBy("row_id").limit(limit)
    ended = parts.where("state = 'finished'")
    text = ["submit_time", "requested", "node", "progress"]
    shown = (_listing("processing", running.select("row_id", "case_id", "cancer_type", *text))
             .unionByName(_listing("queued", first.select("row_id", "case_id", "cancer_type", *sized)))
             .unionByName(_listing("finished", ended.select("row_id", "case_id", "cancer_type", "stage", *sized))))
    # a listed sample is counted where it is listed, the queue as a whole
    counted = running.agg(F.count("*").alias("running")).select(F.lit("running").alias("case_id"), F.col("running").alias("n"))
    for name, kind in (("waiting_count", "queued"), ("finished", "finished")):
        counted = counted.unionByName(parts.where(F.col("state") == kind).agg(F.count("*").alias("n")).select(F.lit(name).alias("case_id"), "n"))
    return shown.unionByName(_listing("counts", counted))


def _listing(name: str, rows: DataFrame) -> DataFrame:
    """Rows in the columns that all listings share."""
    kinds = {"row_id": "bigint", "case_id": "string", "cancer_type": "string", "tumor_size": "string", "normal_size": "string", "stage": "int",
             "submit_time": "string", "requested": "string", "node": "string", "progress": "string", "n": "bigint"}
    return rows.select(F.lit(name).alias("listing"), *((F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()))


def filter_nodes(nodes: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Nodes asked for by name; ``None`` or ``["all"]`` keeps every node."""
    if names is None or [n.lower() for n in names] == ["all"]:
        return nodes
    return nodes.where(F.col("node").isin(names))


def jobs_per_node(jobs: DataFrame) -> DataFrame:
    """Jobs asking for each node."""
    asked = project_jobs(jobs).select(F.explode("req_nodes").alias("node"))
    return asked.groupBy("node").agg(F.count("*").alias("jobs_requested"))


def node_status(nodes: DataFrame, jobs: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Nodes with the number of jobs asking for them and their label."""
    counted = filter_nodes(nodes, names).join(jobs_per_node(jobs), "node", "left").fillna(0, ["jobs_requested"])
    return counted.withColumn("label", node_label(F.col("state")))


def least_loaded(nodes: DataFrame, jobs: DataFrame) -> DataFrame:
    """The usable node fewest jobs ask for, by name on ties."""
    usable = nodes.where(~F.col("state").isin(DOWN_STATES))
    return node_status(usable, jobs).orderBy("jobs_requested", "node").limit(1)


def jobs_by_case(jobs: DataFrame, page_size: int = 1000) -> DataFrame:
    """Case and page to map of job id to fields.

    Page ``p`` of every case, large or small, has the job ids from ``p * page_size`` on, so no
    map holds more than ``page_size`` jobs.
    """
    listed = project_jobs(jobs).withColumn("page", F.floor(F.col("job_id") / page_size).cast("bigint"))
    fields = F.struct(*(c for c in listed.columns if c not in ("case_id", "job_id", "page")))
    entries = F.array_sort(F.collect_list(F.struct("job_id", fields.alias("fields"))))
    return listed.groupBy("case_id", "page").agg(F.map_from_entries(entries).alias("jobs"))


def manager_counts(pairs_done: DataFrame, state: DataFrame) -> DataFrame:
    """Dashboard counters from pairs already verified and a table with a ``state`` column."""
    value = F.col("state")
    counts = state.agg(
        F.count_if(value == "queued").alias("waiting_count"),
        F.count_if(value == "processing").alias("running"),
        F.count_if(value == "finished").alias("finished"),
    )
    verified = pairs_done.agg(F.count("*").alias("n")).scalar()
    return counts.withColumn("phase1_finished", verified)


def take_queue(queued: DataFrame, n: int, order: str) -> DataFrame:
    """First ``n`` queued samples, one per case (the last duplicate of those wins)."""
    return last_per_key(queued.orderBy(order).limit(n), "case_id", order)


def queue_preview(queued: DataFrame, order: str, n: int = 50) -> DataFrame:
    """First ``n`` queued rows, marked when the report ends there and hides the rest."""
    first = queued.orderBy(order).limit(n)
    return first.withColumn("more_hidden", queued.agg(F.count("*")).scalar() > n)


def submit_batch(queued: DataFrame, n: int, accepted: DataFrame, order: str,
                 mode: str = "intended") -> DataFrame:
    """State changes when the first ``n`` queued samples are submitted.

    Rows ``(case_id, from_state, to_state)``: accepted cases go to processing. Rejected
    ones stay queued, except in ``parity`` mode, where they leave the queue for nowhere.
    """
    chosen = take_queue(queued, n, order)
    flags = accepted.select("case_id").distinct().withColumn("_ok", F.lit(True))
    marked = chosen.join(flags, "case_id", "left")
    to_state = F.when(F.col("_ok"), "processing")
    if mode == "intended":
        marked = marked.where("_ok")
    return marked.select("case_id", F.lit("queued").alias("from_state"), to_state.alias("to_state"))


def submit_case(queued: DataFrame, case: str, accepted: bool) -> DataFrame:
    """State change of one case, only when its submission was accepted."""
    moved = queued.where((F.col("case_id") == case) & F.lit(accepted))
    return moved.select("case_id").distinct().select(
        "case_id", F.lit("queued").alias("from_state"), F.lit("processing").alias("to_state"))


def finish_transition(processing: DataFrame, finished: DataFrame, records: DataFrame) -> DataFrame:
    """Changes of the processing rows whose files (``normal``, ``tumor``) have a finish record.

    Every such row leaves ``processing``. ``inserted`` marks the first row of a case (by ``row_id``)
    that is not in ``finished`` yet; the insert of the others is ignored.
    """
    ended = records.select(F.col("normal").alias("normal_file"), F.col("tumor").alias("tumor_file")).distinct()
    leaving = processing.join(ended, ["normal_file", "tumor_file"], "left_semi")
    known = finished.select("case_id", F.lit(True).alias("_known")).distinct()
    first = leaving.groupBy("case_id").agg(F.min("row_id").alias("_first"))
    marked = leaving.join(known, "case_id", "left").join(first, "case_id")
    return marked.select(
        "row_id", "case_id", "normal_file", "tumor_file", F.lit("processing").alias("from_state"), F.lit("finished").alias("to_state"),
        (F.col("_known").isNull() & (F.col("row_id") == F.col("_first"))).alias("inserted"))


def finish_running(running: DataFrame, records: DataFrame) -> DataFrame:
    """Registered runs that end: those of files with a finish record."""
    return running.join(records.select("normal", "tumor").distinct(), ["normal", "tumor"], "left_semi")


def register_running(events: DataFrame) -> DataFrame:
    """First event of each (normal, tumor, stage, reference): the registered runs."""
    keys = [c for c in ("normal", "tumor", "stage", "reference") if c in events.columns]
    return events.groupBy(*keys).agg(F.min("event_id").alias("event_id"))


def current_stage(events: DataFrame) -> DataFrame:
    """Stage of the last event, in arrival order, of each normal and tumor file."""
    return events.groupBy("normal", "tumor").agg(
        F.max_by("stage", "event_id").alias("stage"), F.max("event_id").alias("event_id"))


def by_stage(df: DataFrame, op: str = "=", stage: int = FINAL_STAGE) -> DataFrame:
    """Rows at (``=``) or before (``<``) a stage."""
    if op not in ("=", "<"):
        raise ValueError("op must be '=' or '<'")
    return df.where(F.col("stage") == stage if op == "=" else F.col("stage") < stage)


def mirror_stage(processing: DataFrame, current: DataFrame) -> DataFrame:
    """Processing rows with the current stage of their files; rows without one keep theirs."""
    now = current.select(F.col("normal").alias("normal_file"), F.col("tumor").alias("tumor_file"),
                         F.col("stage").alias("_stage"))
    old = F.col("stage") if "stage" in processing.columns else F.lit(None).cast("int")
    joined = processing.join(now, ["normal_file", "tumor_file"], "left")
    return joined.withColumn("stage", F.coalesce("_stage", old)).drop("_stage")


def reset_plan(finished: bool = False, everything: bool = False, only_finished: bool = False) -> list[str]:
    """Names of the state tables a reset empties."""
    names = [] if only_finished else list(RUN_TABLES)
    if everything:
        names += METRIC_TABLES
    if finished or only_finished:
        names.append(FINISHED_TABLE)
    return names


def reset_rows(state: DataFrame, names: list[str], table: str = "table_name") -> DataFrame:
    """Rows that stay when the named tables are emptied."""
    return state.where(~F.col(table).isin(names))
