"""Parent/child fetches in three plan shapes that return the same rows.

Orders with their details:

* ``orders_nested_join``    (J2) one LEFT JOIN, then group the joined rows.
* ``orders_nested_batch``   (J3) fetch the children of the parent keys, group
  them, join back.
* ``orders_nested_lateral`` (J4) the per-parent lookup written as a LEFT
  LATERAL join; Catalyst decorrelates it into one equi-join.

In all shapes the children are first semi-joined on the parent keys, written
plainly: Catalyst, or adaptive execution from the bytes it measures, broadcasts
the keys or shuffles both sides.  Where the keys' estimate is too large to broadcast,
details of other parents are first dropped where they are read, all but a few, by
hashed bits of the keys (``strategy.key_filtered``), so no shape shuffles all
details.  No shape runs a job while it is built.

Employees with their department (J5-J7) likewise: join, batch on the distinct
department keys, and a correlated scalar subquery.  Departments is a whole
dimension table, so Catalyst's size estimate decides broadcast vs shuffle.

Each nested row is ``parent columns + chunk + details: array<struct<...>>``; a
childless parent has ``[]``.  Children are sorted by the ``detail_cols`` struct
(sort keys first).  A parent has one row (``chunk`` 0) unless it has more than
``max_children`` children; then they lie on several pages in that order (see
``chunking``), and no task ever gets all of them.  All three shapes give the same rows, in
(order_id, chunk) order when ``ordered``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fetchplan.functions.scalar import look_back
from fetchplan.operators.chunking import DEFAULT_MAX_CHILDREN, page_counts, parent_pages, with_page
from fetchplan.operators.lookups import DETAIL_COLS, ORDER_COLS
from fetchplan.plans.strategy import key_filtered


def _parents(orders: DataFrame, as_of, days: int, parent_cols: list[str]) -> DataFrame:
    return orders.filter(look_back("order_date", as_of, days)).select(*parent_cols)


def _paged(details: DataFrame, parents: DataFrame, cols: list[str],
           max_children: int | None) -> tuple[DataFrame, DataFrame]:
    """Pages of the parents, and the children of these parents with their page.

    Other parents' children are dropped by a semi join before anything else.
    """
    keys = parents.select("order_id")
    kids = key_filtered(details.select("order_id", *cols), keys, "order_id").join(keys, "order_id", "left_semi")
    pages = page_counts(kids, "order_id", max_children, cols)
    return parent_pages(parents, "order_id", pages), with_page(kids, "order_id", cols, pages)


def _finish(df: DataFrame, parent_cols: list[str], ordered: bool) -> DataFrame:
    df = df.select(*parent_cols, "chunk", "details")
    return df.orderBy("order_id", "chunk") if ordered else df


def _group(joined: DataFrame, parent_cols: list[str], cols: list[str]) -> DataFrame:
    """Details of joined (parent page, child) rows: ``[]`` without a child, and no row for a page of several that no child fell on."""
    item = F.when(F.col("_present"), F.struct(*[F.col(c) for c in cols]))
    kept = joined.filter((F.col("_pages") <= 1) | F.col("_present"))
    return kept.groupBy(*parent_cols, "chunk").agg(F.array_sort(F.collect_list(item)).alias("details"))


def orders_details_flat(orders: DataFrame, details: DataFrame, as_of, days: int = 30,
                        detail_cols: Iterable[str] = DETAIL_COLS,
                        parent_cols: Iterable[str] = ORDER_COLS,
                        ordered: bool = True, max_children: int | None = DEFAULT_MAX_CHILDREN) -> DataFrame:
    """Flat LEFT JOIN of recent orders and their details."""
    pc, dc = list(parent_cols), [c for c in detail_cols if c != "order_id"]
    pages, kids = _paged(details, _parents(orders, as_of, days, pc), dc, max_children)
    joined = pages.join(kids.withColumn("_present", F.lit(True)), ["order_id", "chunk"], "left")
    out = joined.filter((F.col("_pages") <= 1) | F.col("_present")).select(*pc, *dc)
    return out.orderBy("order_id", *dc) if ordered else out


def orders_nested_join(orders: DataFrame, details: DataFrame, as_of, days: int = 30,
                       detail_cols: Iterable[str] = DETAIL_COLS,
                       parent_cols: Iterable[str] = ORDER_COLS,
                       ordered: bool = True, max_children: int | None = DEFAULT_MAX_CHILDREN) -> DataFrame:
    """J2 ``GetOrdersWithDetailsJoin``: one LEFT JOIN, then the joined rows are grouped."""
    pc, dc = list(parent_cols), [c for c in detail_cols if c != "order_id"]
    pages, kids = _paged(details, _parents(orders, as_of, days, pc), dc, max_children)
    # merged on (order_id, chunk), the rows are grouped where they are: no second shuffle, of nested rows
    joined = pages.join(kids.withColumn("_present", F.lit(True)).hint("merge"), ["order_id", "chunk"], "left")
    return _finish(_group(joined, pc, dc), pc, ordered)


def orders_nested_batch(orders: DataFrame, details: DataFrame, as_of, days: int = 30,
                        detail_cols: Iterable[str] = DETAIL_COLS,
                        parent_cols: Iterable[str] = ORDER_COLS,
                        ordered: bool = True, max_children: int | None = DEFAULT_MAX_CHILDREN) -> DataFrame:
    """J3 ``GetOrdersWithDetailsBatch``: parents, one child fetch by key set, assemble."""
    pc, dc = list(parent_cols), [c for c in detail_cols if c != "order_id"]
    pages, kids = _paged(details, _parents(orders, as_of, days, pc), dc, max_children)
    nested = kids.groupBy("order_id", "chunk").agg(
        F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in dc]))).alias("details"))
    out = pages.join(nested, ["order_id", "chunk"], "left").withColumn(
        "details", F.coalesce(F.col("details"), F.array()))
    return _finish(out.filter((F.col("_pages") <= 1) | (F.size("details") > 0)), pc, ordered)


def orders_nested_lateral(orders: DataFrame, details: DataFrame, as_of, days: int = 30,
                          detail_cols: Iterable[str] = DETAIL_COLS,
                          parent_cols: Iterable[str] = ORDER_COLS,
                          ordered: bool = True, max_children: int | None = DEFAULT_MAX_CHILDREN) -> DataFrame:
    """J4 ``GetOrdersWithDetails``: per-parent child lookup as a LEFT LATERAL join.

    The reference leaves a childless parent with a nil list; like J2/J3 we
    return ``[]``.
    """
    pc, dc = list(parent_cols), [c for c in detail_cols if c != "order_id"]
    pages, kids = _paged(details, _parents(orders, as_of, days, pc), dc, max_children)
    per_page = (kids.hint("merge").alias("d")
                .where((F.col("d.order_id") == F.col("p.order_id").outer())
                       & (F.col("d.chunk") == F.col("p.chunk").outer()))
                .select(*[F.col(f"d.{c}").alias(f"_d_{c}") for c in dc],
                        F.lit(True).alias("_present")))
    joined = pages.alias("p").lateralJoin(per_page, how="left")
    renamed = joined.select(*[F.col(f"p.{c}").alias(c) for c in [*pc, "_pages", "chunk"]],
                            *[F.col(f"_d_{c}").alias(c) for c in dc], "_present")
    return _finish(_group(renamed, pc, dc), pc, ordered)


def flatten_nested(nested: DataFrame) -> DataFrame:
    """One row per parent with totals over all its pages.

    ``detail_count``, ``detail_amount`` (exact), ``quantity_sum`` and
    ``product_quantity_sum`` (product id times quantity); 0 for a childless
    parent.  Each page is summed on its own first, so the result does not depend
    on paging.
    """
    def total(item, kind: str):
        return F.aggregate("details", F.lit(0).cast(kind), lambda acc, x: (acc + item(x)).cast(kind))

    parents = [c for c in nested.columns if c not in ("chunk", "details")]
    per_page = nested.select(
        *parents, F.size("details").cast("bigint").alias("_n"),
        total(lambda x: x["quantity"].cast("decimal(8,0)") * x["unit_price"], "decimal(38,2)").alias("_amount"),
        total(lambda x: x["quantity"].cast("bigint"), "bigint").alias("_quantity"),
        total(lambda x: x["product_id"] * x["quantity"], "bigint").alias("_product"))
    return per_page.groupBy(*parents).agg(
        F.sum("_n").alias("detail_count"), F.sum("_amount").cast("decimal(38,2)").alias("detail_amount"),
        F.sum("_quantity").alias("quantity_sum"), F.sum("_product").alias("product_quantity_sum"))


def child_rows(nested: DataFrame) -> DataFrame:
    """A nested result as parent and child rows; a childless parent has one row with null child columns."""
    parents = [c for c in nested.columns if c not in ("chunk", "details")]
    fields = nested.schema["details"].dataType.elementType.names
    return nested.filter((F.size("details") > 0) | (F.col("chunk") == 0)).select(
        *parents, F.explode_outer("details").alias("_d")).select(*parents, *[F.col(f"_d.{c}").alias(c) for c in fields])


def places_in_pages(nested: DataFrame) -> DataFrame:
    """(order_id, chunk, place, detail): each child's place, from 1, when its parent's pages are read one after another.

    One row a page tells how many children the pages before it hold; no child is moved.
    """
    earlier = Window.partitionBy("order_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    pages = nested.select("order_id", "chunk", F.size("details").alias("_n"))
    before = pages.select("order_id", "chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    items = nested.join(before, ["order_id", "chunk"]).select("order_id", "chunk", "_before", F.posexplode("details").alias("_at", "detail"))
    return items.select("order_id", "chunk", (F.col("_before") + F.col("_at") + 1).alias("place"), "detail")


# ------------------------------------------------------------- employees

EMP_COLS = ("employee_id", "first_name", "last_name", "email", "department_id",
            "hire_date", "salary")


def _department_struct(name: Column, location: Column, dept_id: Column) -> Column:
    """Department of an employee: NULL unless both name and location are present."""
    return F.when(name.isNotNull() & location.isNotNull(),
                  F.struct(dept_id.alias("department_id"), name.alias("department_name"),
                           location.alias("location")))


def _dept_side(departments: DataFrame) -> DataFrame:
    return departments.select(F.col("department_id").alias("_dk"),
                              F.col("department_name").alias("_dn"),
                              F.col("location").alias("_dl"))


def employees_departments_join(employees: DataFrame, departments: DataFrame,
                               ordered: bool = True) -> DataFrame:
    """J5 ``GetEmployeesWithDepartmentJoin``: LEFT JOIN, nullable department struct."""
    d = _dept_side(departments)
    j = employees.select(*EMP_COLS).join(d, F.col("department_id") == F.col("_dk"), "left")
    out = j.select(*EMP_COLS, _department_struct(F.col("_dn"), F.col("_dl"),
                                                 F.col("department_id")).alias("department"))
    return out.orderBy("employee_id") if ordered else out


def employees_departments_batch(employees: DataFrame, departments: DataFrame,
                                ordered: bool = True) -> DataFrame:
    """J6 ``GetEmployeesWithDepartmentBatch``: distinct keys -> fetch -> attach."""
    emps = employees.select(*EMP_COLS)
    keys = emps.select("department_id").filter(F.col("department_id").isNotNull()).distinct()
    fetched = _dept_side(departments).join(keys.withColumnRenamed("department_id", "_dk"), "_dk", "left_semi")
    j = emps.join(fetched, F.col("department_id") == F.col("_dk"), "left")
    out = j.select(*EMP_COLS, _department_struct(F.col("_dn"), F.col("_dl"),
                                                 F.col("department_id")).alias("department"))
    return out.orderBy("employee_id") if ordered else out


def employees_departments_lateral(employees: DataFrame, departments: DataFrame,
                                  ordered: bool = True) -> DataFrame:
    """J7 ``GetEmployeesWithDepartment``: per-row department lookup as a correlated
    scalar subquery; Catalyst rewrites it into a single left join.  A repeated
    department id fails the query (a scalar subquery returns at most one
    row), where the join shape would repeat the employee."""
    e = employees.select(*EMP_COLS).alias("e")
    sub = (departments.alias("d")
           .where(F.col("d.department_id") == F.col("e.department_id").outer())
           .select(_department_struct(F.col("d.department_name"), F.col("d.location"),
                                      F.col("d.department_id")))
           .scalar())
    out = e.select(*[F.col(f"e.{c}").alias(c) for c in EMP_COLS], sub.alias("department"))
    return out.orderBy("employee_id") if ordered else out


def flatten_employees(df: DataFrame) -> DataFrame:
    """Flat check columns of a nested employee result."""
    return df.select(*EMP_COLS,
                     F.col("department.department_name").alias("department_name"),
                     F.col("department.location").alias("location"))
