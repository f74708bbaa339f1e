"""Business table schemas and loading.

The four business tables are the parent/child model of the workload:
departments <- employees, orders <- order_details.  Money is DECIMAL, dates
are TIMESTAMP_NTZ (an Oracle DATE carries seconds).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEPARTMENTS = T.StructType([
    T.StructField("department_id", T.LongType(), False),
    T.StructField("department_name", T.StringType(), False),
    T.StructField("location", T.StringType(), True),
])

EMPLOYEES = T.StructType([
    T.StructField("employee_id", T.LongType(), False),
    T.StructField("first_name", T.StringType(), False),
    T.StructField("last_name", T.StringType(), False),
    T.StructField("email", T.StringType(), False),
    T.StructField("department_id", T.LongType(), True),
    T.StructField("salary", T.DecimalType(10, 2), True),
    T.StructField("hire_date", T.TimestampNTZType(), True),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("customer_name", T.StringType(), False),
    T.StructField("order_date", T.TimestampNTZType(), True),
    T.StructField("total_amount", T.DecimalType(12, 2), True),
    T.StructField("status", T.StringType(), True),
])

ORDER_DETAILS = T.StructType([
    T.StructField("detail_id", T.LongType(), False),
    T.StructField("order_id", T.LongType(), False),
    T.StructField("product_id", T.LongType(), False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("unit_price", T.DecimalType(10, 2), False),
])

SCHEMAS = {
    "departments": DEPARTMENTS,
    "employees": EMPLOYEES,
    "orders": ORDERS,
    "order_details": ORDER_DETAILS,
}

# Columns the DDL has besides, kept in their declared type where a source has them.
OPTIONAL = T.StructType([
    T.StructField("created_at", T.TimestampNTZType(), True),
    T.StructField("updated_at", T.TimestampNTZType(), True),
    T.StructField("line_amount", T.DecimalType(12, 2), True),
])

# Tables that grow with the business: never read through one connection.
FACT_TABLES = ("orders", "order_details")

# Declared column-length and precision limits (Q4), fixed by the DDL.
VARCHAR_LIMITS = {
    "departments": {"department_name": 100, "location": 100},
    "employees": {"first_name": 50, "last_name": 50, "email": 200},
    "orders": {"customer_name": 100, "status": 20},
    "order_details": {"product_name": 200},
}
NUMBER_LIMITS = {
    "departments": {"department_id": (10, 0)},
    "employees": {"employee_id": (10, 0), "department_id": (10, 0), "salary": (10, 2)},
    "orders": {"order_id": (10, 0), "customer_id": (10, 0), "total_amount": (12, 2)},
    "order_details": {"detail_id": (10, 0), "order_id": (10, 0), "product_id": (10, 0),
                      "quantity": (8, 0), "unit_price": (10, 2)},
}

# Primary keys (Q1), unique keys (Q2) and NOT NULL columns (Q3) of the DDL.
PRIMARY_KEYS = {
    "departments": ["department_id"],
    "employees": ["employee_id"],
    "orders": ["order_id"],
    "order_details": ["detail_id"],
}
UNIQUE_KEYS = {"employees": [["email"]]}
NOT_NULL = {
    "departments": ["department_id", "department_name"],
    "employees": ["employee_id", "first_name", "last_name", "email"],
    "orders": ["order_id", "customer_id", "customer_name"],
    "order_details": ["detail_id", "order_id", "product_id", "product_name",
                      "quantity", "unit_price"],
}


def jdbc_options(url: str, table: str, *, user: str | None = None,
                 password: str | None = None, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int = 10, fetch_size: int = 1000) -> dict:
    """Options for ``spark.read.format("jdbc")``.

    A partitioned read needs column and both bounds together; the bounds only
    stride the partitions, rows outside them are still read.  Without them the
    table comes through one connection.  ``num_partitions`` is the number of
    concurrent connections, the role of the reference's pool size.
    """
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    bounds = (partition_column, lower_bound, upper_bound)
    if any(b is not None for b in bounds):
        if not all(b is not None for b in bounds):
            raise ValueError("partition_column, lower_bound and upper_bound go together")
        if lower_bound >= upper_bound:
            raise ValueError("lower_bound must be below upper_bound")
        opts.update({
            "partitionColumn": partition_column,
            "lowerBound": str(lower_bound),
            "upperBound": str(upper_bound),
            "numPartitions": str(num_partitions),
        })
    return opts


def _read_jdbc(spark: SparkSession, url: str, name: str, per: dict) -> DataFrame:
    """One table; a fact table needs partition bounds or ``predicates`` (one task each)."""
    per = dict(per)
    predicates = per.pop("predicates", None)
    if name in FACT_TABLES and not predicates and per.get("partition_column") is None:
        raise ValueError(f"{name}: give partition bounds or predicates, else all rows come through one connection")
    opts = jdbc_options(url, per.pop("table", name), **per)
    if not predicates:
        return spark.read.format("jdbc").options(**opts).load()
    table = opts.pop("dbtable")
    return spark.read.jdbc(opts.pop("url"), table, predicates=list(predicates), properties=opts)


def declared(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the declared columns of table ``name`` first, in their types.

    Names match whatever their letter case (a database reports upper case).  A
    missing declared column is an error; optional ones are cast where present,
    others kept as they are.
    """
    actual = {c.lower(): c for c in df.columns}
    if len(actual) != len(df.columns):
        raise ValueError(f"{name}: columns that differ in letter case only: {df.columns}")
    fields = SCHEMAS[name].fields
    missing = [f.name for f in fields if f.name not in actual]
    if missing:
        raise ValueError(f"{name}: no column {', '.join(missing)} among {df.columns}")
    fields = fields + [f for f in OPTIONAL.fields if f.name in actual]
    named = {f.name for f in fields}
    return df.select(*[F.col(f"`{actual[f.name]}`").cast(f.dataType).alias(f.name) for f in fields],
                     *[F.col(f"`{c}`") for low, c in actual.items() if low not in named])


def load_tables(spark: SparkSession, source: dict,
                names=("departments", "employees", "orders", "order_details")) -> dict[str, DataFrame]:
    """Load the business tables from parquet or JDBC (S2) in their declared schemas.

    ``source = {"format": "parquet", "path": "/data/shop"}`` reads
    ``{path}/{name}.parquet``; ``{"format": "jdbc", "url": ..., "options": {name: {...}}}``
    reads each table through ``jdbc_options``, or by ``predicates``.
    """
    fmt = source.get("format", "parquet")
    out = {}
    for name in names:
        if fmt == "parquet":
            df = spark.read.parquet(f"{source['path']}/{name}.parquet")
        elif fmt == "jdbc":
            df = _read_jdbc(spark, source["url"], name, source.get("options", {}).get(name, {}))
        else:
            raise ValueError(f"unknown source format {fmt!r}")
        out[name] = declared(df, name)
    return out


def employees_scan(employees: DataFrame) -> DataFrame:
    """All employees, seven columns, in key order."""
    return employees.select(
        "employee_id", "first_name", "last_name", "email", "department_id",
        "salary", "hire_date",
    ).orderBy("employee_id")


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None,
                   mode: str = "overwrite") -> None:
    """Save ``df`` as a catalog table bucketed and sorted by ``key``.

    Two tables bucketed the same way on the join key (orders and
    order_details on order_id) join without a shuffle on either side: the
    physical counterpart of the reference's order_id indexes.
    """
    w = df.write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key)
    if path is not None:
        w = w.option("path", path)
    w.saveAsTable(table)


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Publish the business tables as session temp views (``{prefix}orders`` ...)
    so plain SQL can join and group them; returns the view names."""
    names = []
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    return names


# Connection defaults of the workload (host, port, service name)
# and its pool limit, which becomes the JDBC read parallelism.
DEFAULT_DB_HOST = "localhost"
DEFAULT_DB_PORT = 1521
DEFAULT_DB_SERVICE = "ORCLPDB1"
MAX_OPEN_CONNECTIONS = 10


def oracle_jdbc_url(host: str = DEFAULT_DB_HOST, port: int = DEFAULT_DB_PORT,
                    service: str = DEFAULT_DB_SERVICE) -> str:
    """Thin-driver JDBC URL for a database service."""
    return f"jdbc:oracle:thin:@//{host}:{int(port)}/{service}"


def jdbc_source(settings: dict, partitions: dict | None = None, connections: int = MAX_OPEN_CONNECTIONS) -> dict:
    """A ``load_tables`` source from connection settings.

    ``settings`` uses the workload's keys (``DB_HOST``, ``DB_PORT``,
    ``DB_SERVICE_NAME``, ``DB_USERNAME``, ``DB_PASSWORD``) with its defaults
    for the first three; the caller passes them in (for example from Spark
    conf).  ``partitions`` maps a table to ``(column, lower, upper)`` for a
    partitioned read; each table reads with at most ``connections`` connections.
    """
    url = oracle_jdbc_url(settings.get("DB_HOST", DEFAULT_DB_HOST),
                          int(settings.get("DB_PORT", DEFAULT_DB_PORT)),
                          settings.get("DB_SERVICE_NAME", DEFAULT_DB_SERVICE))
    options = {}
    for name in SCHEMAS:
        per = {"user": settings.get("DB_USERNAME"), "password": settings.get("DB_PASSWORD"),
               "num_partitions": connections}
        if partitions and name in partitions:
            col, lo, hi = partitions[name]
            per.update({"partition_column": col, "lower_bound": lo, "upper_bound": hi})
        options[name] = per
    return {"format": "jdbc", "url": url, "options": options}
