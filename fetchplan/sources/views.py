"""Stand-in views over the driver tables.

The driver ships TPC-H-like tables plus an ``events`` table.  These builders
rename and cast driver columns into the business schemas and apply per-row
value rules (no row is removed); they do none of an operator's work.  Each builder has a DuckDB twin in ``SQL`` so the oracle
queries read exactly the same input.

    orders         <- orders (+ customer only when customer_name is asked for)
    order_details  <- lineitem (no unique detail id: order by the line tuple)
    departments    <- nation x region (names repeat per region, one region without location)
    employees      <- customer (department = nation key + 1: orphans and an empty department)
    measurement tables (runs, run_log, counter_snapshots, name_values, waits,
    size_estimates, components, pools, objects, cache_results) <- events
    raw tables (Q1-Q4) <- nation, customer, orders, lineitem
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fetchplan.functions.scalar import ntz

# Fixed values of the stand-in data: the reference date is the last order date
# present in the driver tables at every scale factor.
AS_OF = _dt.datetime(2001, 8, 1, 0, 0, 0)
AS_OF_SQL = "TIMESTAMP '2001-08-01 00:00:00'"
HIRE_BASE = _dt.datetime(2020, 1, 1, 0, 0, 0)
NULL_LOCATION_REGION = 4

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")

# The line tuple that orders details when no unique detail id exists.
DETAIL_ORDER = ("line_number", "product_id", "supplier_id", "quantity", "unit_price")


@dataclass
class Driver:
    """Lazily read driver tables of one scale-factor folder."""
    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]


def driver(spark: SparkSession, sf_dir: str) -> Driver:
    """Readers of one scale-factor folder; each table is resolved once per query."""
    return Driver(spark, sf_dir.rstrip("/"))


def _k(props: Column) -> Column:
    return F.regexp_extract(props, r"([0-9]+)", 1).try_cast("int")


def _cents(value: Column) -> Column:
    return F.round(value * 100).cast("bigint")


# ---------------------------------------------------------------- business

def orders(d: Driver, with_customer_name: bool = False) -> DataFrame:
    o = d.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
        F.col("o_orderstatus").alias("status"),
    )
    if with_customer_name:
        c = d.customer.select(F.col("c_custkey").alias("customer_id"),
                              F.col("c_name").alias("customer_name"))
        o = o.join(c, "customer_id", "left")
    return o


def order_details(d: Driver) -> DataFrame:
    return d.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("unit_price"),
    )


def departments(d: Driver) -> DataFrame:
    """One department per nation; the name is the region's (names repeat) and
    the location is NULL in one region (department struct NULL)."""
    n = d.nation
    return n.join(d.region, n.n_regionkey == d.region.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("department_id"),
        F.col("r_name").alias("department_name"),
        F.when(F.col("n_regionkey") != NULL_LOCATION_REGION, F.col("n_name")).alias("location"),
    )


def employees(d: Driver) -> DataFrame:
    """One employee per customer; the department id is the nation key plus
    one, so the last nation's customers point at a missing department and
    department 0 has nobody."""
    return d.customer.select(
        F.col("c_custkey").alias("employee_id"),
        F.lit("").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        (F.col("c_nationkey").cast("bigint") + 1).alias("department_id"),
        F.col("c_acctbal").cast("decimal(10,2)").alias("salary"),
        (ntz(HIRE_BASE)
         + F.make_dt_interval(F.col("c_custkey").cast("int"))).alias("hire_date"),
    )


# ------------------------------------------------------------- measurements

def runs(d: Driver) -> DataFrame:
    """runs(suite, seq, method, exec_ns, record_count); seq is the event id."""
    e = d.events
    return e.select(
        F.col("user_id").alias("suite"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("method"),
        (_cents(F.col("value")) * 10000).alias("exec_ns"),
        _k(F.col("props")).cast("bigint").alias("record_count"),
    )


def run_log(d: Driver) -> DataFrame:
    """run_log(grp, run_no, exec_ms, hit)."""
    e = d.events
    return e.select(
        F.col("user_id").alias("grp"),
        F.col("event_id").alias("run_no"),
        F.col("value").alias("exec_ms"),
        (F.col("event_type") == "view").alias("hit"),
    )


def cache_results(d: Driver) -> DataFrame:
    """cache_results(grp, method, exec_ns, memory_bytes, hit_rate)."""
    e = d.events
    k = _k(F.col("props"))
    return e.select(
        F.col("user_id").alias("grp"),
        F.col("event_type").alias("method"),
        F.col("event_id").alias("seq"),
        (_cents(F.col("value")) * 10000).alias("exec_ns"),
        (k.cast("bigint") * 65536).alias("memory_bytes"),
        k.cast("double").alias("hit_rate"),
    )


def counter_snapshots(d: Driver) -> DataFrame:
    """One counter reading per event; each reading is a function of its own row."""
    e = d.events
    k = _k(F.col("props")).cast("bigint")
    eid = F.col("event_id")
    return e.select(
        F.col("user_id").alias("source"),
        F.col("ts").alias("taken_at"),
        eid.alias("snapshot_no"),
        k.cast("double").alias("buffer_hit_ratio"),
        F.col("value").alias("result_hit_ratio"),
        (eid * 100).alias("logical_reads"),
        (eid * (k % 10)).alias("physical_reads"),
        (eid * 70 + k).alias("consistent_gets"),
        (eid * 30 - k).alias("db_block_gets"),
        (k * 2).alias("free_waits"),
        ((99 - k) * 2).alias("busy_waits"),
        ((k + 1) * 1048576).alias("total_bytes"),
        (eid * 3).alias("objects"),
        (eid * 5 + k).alias("blocks"),
        (eid * 2 + k).alias("created"),
        (eid - k).alias("expired"),
        (eid + k).alias("invalidated"),
        (eid * 2 - k).alias("invalidation_dependencies"),
        (eid * 65536).alias("memory_bytes"),
    )


def name_values(d: Driver) -> DataFrame:
    """name_values(source, name, value): one counter value per event."""
    e = d.events
    return e.select(
        F.col("user_id").alias("source"),
        F.col("event_type").alias("name"),
        _k(F.col("props")).cast("bigint").alias("value"),
    )


def waits(d: Driver) -> DataFrame:
    """waits(event, total_waits, time_waited_micro): one reading per event."""
    e = d.events
    k = _k(F.col("props")).cast("bigint")
    return e.select(
        F.col("event_id"),
        F.concat(F.col("event_type"), F.lit(" "), F.col("user_id").cast("string")).alias("event"),
        (k % 7).alias("total_waits"),
        (k % 3).alias("total_timeouts"),
        (_cents(F.col("value")) * 1000).alias("time_waited_micro"),
    )


def size_estimates(d: Driver) -> DataFrame:
    e = d.events
    return e.select(
        F.col("event_id"),
        F.col("event_type").alias("name"),
        F.lit("READY").alias("status"),
        (_k(F.col("props")) / 50.0).alias("size_factor"),
        (F.col("value") / 50.0).alias("read_factor"),
    )


def components(d: Driver) -> DataFrame:
    e = d.events
    return e.select(
        F.col("event_id"),
        F.col("event_type").alias("component"),
        (_k(F.col("props")).cast("bigint") * 1048576).alias("bytes"),
    )


def pools(d: Driver) -> DataFrame:
    """pools(name, block_size, current_bytes): one pool per event."""
    e = d.events
    k = _k(F.col("props")).cast("bigint")
    return e.select(
        F.concat(F.col("event_type"), F.lit(" "), F.col("event_id").cast("string")).alias("name"),
        ((k % 4 + 1) * 4096).alias("block_size"),
        (k * 1048576 + F.col("user_id")).alias("current_bytes"),
    )


def objects(d: Driver) -> DataFrame:
    e = d.events
    return e.select(
        F.col("event_type").alias("type"),
        _k(F.col("props")).cast("bigint").alias("blocks"),
    )


# Business tables as a loader might find them: keys that repeat, missing
# values, long texts and numbers as text that their declared type can't hold.

def raw_tables(d: Driver) -> dict[str, DataFrame]:
    c, o, li, n = d.customer, d.orders, d.lineitem, d.nation
    return {
        "departments": n.select(
            F.col("n_regionkey").cast("bigint").alias("department_id"),
            F.nullif(F.col("n_name"), F.lit("NATION_0")).alias("department_name"),
            F.repeat(F.col("n_name"), 12).alias("location")),
        "employees": c.select(
            F.col("c_custkey").alias("employee_id"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.concat(F.col("c_mktsegment"), F.col("c_nationkey").cast("string"), F.lit("@example.com")).alias("email"),
            F.col("c_nationkey").cast("bigint").alias("department_id"),
            (F.col("c_acctbal").cast("decimal(12,2)") * 100000).cast("string").alias("salary")),
        "orders": o.select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
            F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("customer_name"),
            F.concat(F.col("o_totalprice").cast("decimal(12,2)").cast("string"),
                     F.when(F.col("o_orderstatus") == "F", F.lit("5")).otherwise(F.lit(""))).alias("total_amount"),
            F.repeat(F.col("o_orderpriority"), 2).alias("status")),
        "order_details": li.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("detail_id"), F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"), F.nullif(F.col("l_returnflag"), F.lit("R")).alias("product_name"),
            F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("decimal(10,0)").cast("string"))
            .otherwise(F.lit("n/a")).alias("quantity"),
            (F.col("l_extendedprice").cast("decimal(12,2)") * 10000).cast("string").alias("unit_price")),
    }


# ----------------------------------------------------------- DuckDB twins

_K_SQL = "TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER)"
_CENTS_SQL = "CAST(round(value * 100) AS BIGINT)"

SQL = {
    "ord": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
        CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount, o_orderstatus AS status FROM orders""",
    "ordc": """SELECT o.*, c.c_name AS customer_name FROM ord o
        LEFT JOIN customer c ON o.customer_id = c.c_custkey""",
    "det": """SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id,
        l_suppkey AS supplier_id, CAST(l_quantity AS INTEGER) AS quantity,
        CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price FROM lineitem""",
    "dept": """SELECT CAST(n_nationkey AS BIGINT) AS department_id, r_name AS department_name,
        CASE WHEN n_regionkey <> 4 THEN n_name END AS location
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "emp": """SELECT c_custkey AS employee_id, '' AS first_name, c_name AS last_name,
        'c' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
        CAST(c_nationkey AS BIGINT) + 1 AS department_id, CAST(c_acctbal AS DECIMAL(10,2)) AS salary,
        TIMESTAMP '2020-01-01 00:00:00' + to_days(CAST(c_custkey AS INTEGER)) AS hire_date
        FROM customer""",
    "runs": f"""SELECT user_id AS suite, event_id AS seq, event_type AS method,
        {_CENTS_SQL} * 10000 AS exec_ns, CAST({_K_SQL} AS BIGINT) AS record_count FROM events""",
    "run_log": """SELECT user_id AS grp, event_id AS run_no, value AS exec_ms,
        (event_type = 'view') AS hit FROM events""",
    "cache_results": f"""SELECT user_id AS grp, event_type AS method, event_id AS seq,
        {_CENTS_SQL} * 10000 AS exec_ns, CAST({_K_SQL} AS BIGINT) * 65536 AS memory_bytes,
        CAST({_K_SQL} AS DOUBLE) AS hit_rate FROM events""",
    "counter_snapshots": f"""SELECT user_id AS source, ts AS taken_at, event_id AS snapshot_no,
        CAST(k AS DOUBLE) AS buffer_hit_ratio, value AS result_hit_ratio,
        event_id * 100 AS logical_reads, event_id * (k % 10) AS physical_reads,
        event_id * 70 + k AS consistent_gets, event_id * 30 - k AS db_block_gets,
        k * 2 AS free_waits, (99 - k) * 2 AS busy_waits, (k + 1) * 1048576 AS total_bytes,
        event_id * 3 AS objects, event_id * 5 + k AS blocks, event_id * 2 + k AS created, event_id - k AS expired,
        event_id + k AS invalidated, event_id * 2 - k AS invalidation_dependencies, event_id * 65536 AS memory_bytes
        FROM (SELECT *, CAST({_K_SQL} AS BIGINT) AS k FROM events)""",
    "name_values": f"""SELECT user_id AS source, event_type AS name, CAST({_K_SQL} AS BIGINT) AS value
        FROM events""",
    "waits": f"""SELECT event_id, event_type || ' ' || CAST(user_id AS VARCHAR) AS event,
        CAST({_K_SQL} AS BIGINT) % 7 AS total_waits, CAST({_K_SQL} AS BIGINT) % 3 AS total_timeouts,
        {_CENTS_SQL} * 1000 AS time_waited_micro
        FROM events""",
    "size_estimates": f"""SELECT event_id, event_type AS name, 'READY' AS status,
        CAST({_K_SQL} AS DOUBLE) / 50.0 AS size_factor, value / 50.0 AS read_factor FROM events""",
    "components": f"""SELECT event_id, event_type AS component,
        CAST({_K_SQL} AS BIGINT) * 1048576 AS bytes FROM events""",
    "pools": f"""SELECT event_type || ' ' || CAST(event_id AS VARCHAR) AS name,
        (CAST({_K_SQL} AS BIGINT) % 4 + 1) * 4096 AS block_size,
        CAST({_K_SQL} AS BIGINT) * 1048576 + user_id AS current_bytes FROM events""",
    "raw_departments": """SELECT CAST(n_regionkey AS BIGINT) AS department_id, nullif(n_name, 'NATION_0') AS department_name,
        repeat(n_name, 12) AS location FROM nation""",
    "raw_employees": """SELECT c_custkey AS employee_id, nullif(c_mktsegment, 'BUILDING') AS first_name, c_name AS last_name,
        c_mktsegment || CAST(c_nationkey AS VARCHAR) || '@example.com' AS email, CAST(c_nationkey AS BIGINT) AS department_id,
        CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 100000 AS VARCHAR) AS salary FROM customer""",
    "raw_orders": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        nullif(o_orderpriority, '5-LOW') AS customer_name,
        CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) || CASE WHEN o_orderstatus = 'F' THEN '5' ELSE '' END AS total_amount,
        repeat(o_orderpriority, 2) AS status FROM orders""",
    "raw_order_details": """SELECT l_orderkey * 10 + l_linenumber AS detail_id, l_orderkey AS order_id,
        l_partkey AS product_id, nullif(l_returnflag, 'R') AS product_name,
        CASE WHEN l_linestatus = 'O' THEN CAST(CAST(l_quantity AS DECIMAL(10,0)) AS VARCHAR) ELSE 'n/a' END AS quantity,
        CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 10000 AS VARCHAR) AS unit_price FROM lineitem""",
    "objects": f"""SELECT event_type AS type, CAST({_K_SQL} AS BIGINT) AS blocks FROM events""",
}

_SQL_DEPS = {"ordc": ["ord"]}


def with_views(*names: str) -> str:
    """``WITH`` clause defining the named DuckDB stand-in views (dependencies first)."""
    order: list[str] = []

    def add(n):
        for dep in _SQL_DEPS.get(n, []):
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in order) + "\n"
