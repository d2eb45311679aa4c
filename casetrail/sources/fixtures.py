"""Raw workflow tables derived from the driver's TPC-H-style parquet tables.

The reference ships no data, so the four raw sources (cases, tasks, task
assignments and the JSON event feed) are derived from ``orders``,
``lineitem`` and ``events`` by fixed rules (see ``FIXTURES.md`` §4).  Every
row of the input tables is used; nothing is sampled.  The same rules are
written as DuckDB SQL in :mod:`casetrail.plans.oracle`.

Driver timestamps are parquet timestamps without a zone (Spark reads them as
``timestamp_ntz``); they are cast to ``timestamp`` once here, under UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, spread


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ts(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("timestamp")


def _mod(c: Column, n: int) -> Column:
    return F.pmod(c, F.lit(n))


def _ts_text(c: Column) -> Column:
    """Timestamp truncated to the second, as ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.date_format(F.date_trunc("second", c), "yyyy-MM-dd HH:mm:ss")


def raw_cases(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """``cw_case``: one row per order; filing date = last ship date of the order."""
    ship = lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("ship"))
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                      "o_orderpriority")
    k = F.col("o_orderkey")
    odate = F.col("o_orderdate").cast("date")
    ship_date = F.col("ship").cast("date")
    return (
        o.join(ship, o.o_orderkey == ship.l_orderkey, "left")
        .select(
            k.alias("id"),
            F.col("o_custkey").alias("beneficiary_id"),
            F.when(_mod(k, 97) != 0, F.col("o_orderpriority")).alias("catalog_product_id"),
            _mod(k, 5).alias("flow_template_id"),
            _mod(k, 15).alias("flow_template_version_id"),
            F.when(F.col("o_orderstatus") == "O", "preparation")
            .when(F.col("o_orderstatus") == "P", "review")
            .otherwise("filing").alias("stage"),
            F.col("o_orderstatus").alias("status"),
            (k * 10).alias("stage_instance_id"),
            F.when(_mod(k, 13) != 0, F.date_add(odate, _mod(k, 30).cast("int"))).alias("kickoff_date"),
            F.when(_mod(k, 5) != 0, F.date_add(odate, _mod(k, 20).cast("int"))).alias("classification_date"),
            ship_date.alias("filing_date_actual"),
            F.date_add(ship_date, 7).alias("receipt_date"),
            F.date_add(ship_date, 90).alias("decision_date"),
            F.when(_mod(k, 11) != 0, _ts("o_orderdate")).alias("initialized_at"),
            F.when(_mod(k, 4) == 0, k).alias("case_matter_case_id"),
            _ts("o_orderdate").alias("created_at"),
            _ts("o_orderdate").alias("updated_at"),
            F.when(_mod(k, 50) == 0, _ts("o_orderdate")).alias("deleted_at"),
            _ts("o_orderdate").alias("ingestion_timestamp"),
        )
    )


def raw_tasks(lineitem: DataFrame) -> DataFrame:
    """``cw_task``: one row per (order, line number) pair of ``lineitem``."""
    grouped = lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_suppkey").alias("min_supp"),
        F.min("l_partkey").alias("min_part"),
        F.min("l_shipdate").alias("min_ship"),
    )
    tid = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    line = F.col("l_linenumber")
    part_bucket = _mod(F.col("min_part"), 10)
    source = (
        F.when(part_bucket == 0, "Manual").when(part_bucket == 1, "custom")
        .when(part_bucket == 2, "user_added").when(part_bucket == 3, "library")
        .when(part_bucket == 4, "shared_library").when(part_bucket == 5, "ai_suggested")
        .otherwise("template")
    )
    created = _ts("min_ship")
    return grouped.select(
        tid.alias("id"),
        F.col("l_orderkey").alias("case_id"),
        F.when(line == 1, "Client Questionnaire").when(line == 2, "Upload documents")
        .otherwise("Review").alias("name"),
        F.lit(None).cast("string").alias("description"),
        F.when(_mod(F.col("min_supp"), 3) != 0, F.col("min_supp")).alias("task_template_id"),
        source.alias("creation_source"),
        F.lit(None).cast("string").alias("case_stage_scope"),
        F.concat(F.lit("stage_"), line.cast("string")).alias("sub_stage"),
        F.lit("open").alias("status"),
        F.lit(None).cast("string").alias("blocked_reason"),
        F.lit(None).cast("boolean").alias("force_unblocked"),
        F.lit(None).cast("timestamp").alias("activation_ts"),
        F.lit(None).cast("timestamp").alias("completion_ts"),
        created.alias("created_at"),
        created.alias("updated_at"),
        F.when(_mod(tid, 43) == 0, created).alias("deleted_at"),
        created.alias("ingestion_timestamp"),
    )


def raw_assignments(tasks: DataFrame) -> DataFrame:
    """``cw_task_assignment``: one assignment per task."""
    i = F.col("id")
    return tasks.select(
        i.alias("id"),
        i.alias("task_id"),
        F.when(_mod(i, 2) == 0, "beneficiary").otherwise("attorney").alias("role_binding"),
        F.lit(None).cast("string").alias("role"),
        F.when(_mod(i, 9) == 0, "fill_Questionnaire")
        .when(F.col("name") == "Upload documents", "upload")
        .otherwise("review").alias("action"),
        F.lit("active").alias("status"),
        _mod(i, 3).alias("iteration_count"),
        _mod(i, 1000).alias("active_time_ms"),
        F.lit(None).cast("boolean").alias("auto_activate"),
        F.when(_mod(i, 6) != 0, F.col("created_at")).alias("activated_ts"),
        F.when(_mod(i, 4) < 2, F.col("created_at")).alias("submitted_ts"),
        F.when(_mod(i, 4) == 0, F.col("created_at")).alias("completed_ts"),
        F.col("created_at"),
        F.col("updated_at"),
        F.when(_mod(i, 61) == 0, F.col("created_at")).alias("deleted_at"),
        F.col("ingestion_timestamp"),
    )


def raw_task_predecessors(lineitem: DataFrame) -> DataFrame:
    """``cw_task_predecessor``: each line's task depends on the previous line's task."""
    return (lineitem.where(F.col("l_linenumber") > 1)
            .groupBy("l_orderkey", "l_linenumber").agg(F.min("l_shipdate").alias("first_ship"))
            .select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("task_id"),
                    (F.col("l_orderkey") * 10 + F.col("l_linenumber") - 1).alias("predecessor_task_id"),
                    _ts("first_ship").alias("ingestion_timestamp")))


def raw_events(events: DataFrame) -> DataFrame:
    """Raw JSON event feed: text timestamps, dirty payload values."""
    e = F.col("event_id")
    ts_text = _ts_text(F.col("ts"))
    et = F.col("event_type")
    name = (
        F.when(et == "view", "cw_task_plugin_opened")
        .when(et == "click", "cw_doc_upload_started")
        .when(et == "purchase", "cw_doc_upload_completed")
        .when((et == "signup") & (_mod(e, 5) == 0), "cw_questionnaire_session_submitted")
        .when(et == "signup", "cw_questionnaire_session_started")
        .otherwise("app_error")
    )
    m = lambda n: _mod(e, n)
    payload = F.concat(
        F.lit('{"event_id":'), e.cast("string"),
        F.lit(',"case_id":"'), (F.col("user_id") * 10).cast("string"),
        F.lit('","task_assignment_id":"'),
        (F.col("user_id") * 100 + m(10) * 10 + 2).cast("string"),
        F.lit('","actor_role":"'), F.when(m(8) == 0, "attorney").otherwise("Beneficiary"),
        F.lit('","task_plugin_type":"'),
        F.when(et == "signup", "questionnaire").when(m(3) == 0, " File_Upload ")
        .otherwise("file_upload"),
        F.lit('","catalog_product_id":"'), _mod(F.col("user_id"), 4).cast("string"),
        F.lit('","user_can_act":'),
        F.when(m(4) == 0, "true").when(m(4) == 1, '"yes"').when(m(4) == 2, '"0"').otherwise('""'),
        F.lit(',"file_count":'),
        F.when(m(6) == 0, '"3.0"').when(m(6) == 1, "3").when(m(6) == 2, '"1,200"')
        .when(m(6) == 3, '"unknown"').when(m(6) == 4, "null").otherwise('" 2 "'),
        F.lit(',"success_count":'),
        F.when(m(5) == 0, '"3"').when(m(5) == 1, "0").when(m(5) == 2, '"n/a"').otherwise("2"),
        F.lit(',"error_count":'), m(2).cast("string"),
        F.lit(',"duration_ms":'),
        F.when(m(4) == 0, '"1,520"').when(m(4) == 1, "1520.5").otherwise('"1520.0"'),
        F.lit("}"),
    )
    return events.select(
        F.when(m(41) == 0, "not-a-date")
        .when(m(7) == 0, (F.lit(1704067200) + e).cast("string"))
        .when(m(11) == 0, F.concat(ts_text, F.lit("+00")))
        .otherwise(ts_text).alias("event_time"),
        F.when(m(53) == 0, "null").otherwise(ts_text).alias("ingestion_timestamp"),
        name.alias("event_type"),
        payload.alias("event_properties"),
    )


def legacy_cases(orders: DataFrame) -> DataFrame:
    """``cm_case``: the legacy twin of every order."""
    return orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("beneficiary_id"),
        F.col("o_orderpriority").alias("product_id"), F.col("o_orderstatus").alias("status"),
        _ts("o_orderdate").alias("created_at"), _ts("o_orderdate").alias("ingestion_timestamp"))


def legacy_evidence_documents(part: DataFrame, lineitem: DataFrame) -> DataFrame:
    """``cm_evidence_document``: one document per part that a line uses, from its first line."""
    first = lineitem.groupBy(F.col("l_partkey").alias("id")).agg(
        F.min("l_shipdate").alias("first_ship"), F.min("l_orderkey").alias("first_order"))
    return part.select(F.col("p_partkey").alias("id"), "p_type", "p_brand", "p_size").join(first, "id").select(
        "id", F.col("first_order").alias("evidence_id"), F.col("p_type").alias("status"),
        F.col("p_brand").alias("uploaded_by_case_role"),
        F.col("p_size").cast("long").alias("iteration_count"),
        _ts("first_ship").alias("created_at"), _ts("first_ship").alias("ingestion_timestamp"))


def legacy_evidence_properties(supplier: DataFrame, lineitem: DataFrame) -> DataFrame:
    """``cm_evidence_property``: one property per supplier that a line uses, from its first line."""
    first = lineitem.groupBy(F.col("l_suppkey").alias("id")).agg(
        F.min("l_shipdate").alias("first_ship"), F.min("l_orderkey").alias("first_order"))
    return supplier.select(F.col("s_suppkey").alias("id"), "s_nationkey").join(first, "id").select(
        "id", F.col("first_order").alias("evidence_id"),
        F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string")).alias("property_type"),
        _ts("first_ship").alias("created_at"), _ts("first_ship").alias("ingestion_timestamp"))


def legacy_recommenders(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """``cm_recommender``: one recommender per customer with an order, on the first order."""
    first = orders.groupBy(F.col("o_custkey").alias("id")).agg(
        F.min("o_orderkey").alias("case_id"), F.min("o_orderdate").alias("first_order"))
    return customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("status")).join(
        first, "id").select(
        "id", "case_id", "status", _ts("first_order").alias("created_at"),
        _ts("first_order").alias("ingestion_timestamp"))


class RawSources:
    """The raw workflow sources of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    def table(self, name: str) -> DataFrame:
        return self._get("t_" + name, lambda: _table(self.spark, self.sf_dir, name))

    @property
    def cases(self) -> DataFrame:
        return self._get("cases", lambda: raw_cases(self.table("orders"), self.table("lineitem")))

    @property
    def tasks(self) -> DataFrame:
        return self._get("tasks", lambda: raw_tasks(self.table("lineitem")))

    @property
    def assignments(self) -> DataFrame:
        return self._get("assignments", lambda: raw_assignments(self.tasks))

    @property
    def task_predecessors(self) -> DataFrame:
        return self._get("task_predecessors", lambda: raw_task_predecessors(self.table("lineitem")))

    @property
    def events(self) -> DataFrame:
        return self._get("events", lambda: raw_events(self._event_table()))

    def _event_table(self) -> DataFrame:
        """The event table, spread over ``spark.casetrail.eventTasks`` tasks (default: as many as
        a shuffle has).

        A file of one row group is read by one task, whatever its size, and every payload of the
        feed would be built and parsed there; the narrow rows are dealt out before.  They pass a
        generator, below which Spark moves no filter: one on a load time would parse it there.
        """
        columns = ["event_id", "ts", "user_id", "event_type"]
        return spread(self.table("events").select(columns)).select(
            F.inline(F.array(F.struct(*columns))))

    def frames(self) -> dict[str, DataFrame]:
        """Every raw source by the name that the checks and models use."""
        t = self.table
        return {"wf_case": self.cases, "wf_task": self.tasks, "wf_assignment": self.assignments,
                "wf_events": self.events, "wf_task_predecessor": self.task_predecessors,
                "cm_case": legacy_cases(t("orders")),
                "cm_evidence_document": legacy_evidence_documents(t("part"), t("lineitem")),
                "cm_evidence_property": legacy_evidence_properties(t("supplier"), t("lineitem")),
                "cm_recommender": legacy_recommenders(t("customer"), t("orders"))}
