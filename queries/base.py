"""Query registry and the views (with NULLs, row ids, corpora) the queries run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cellwright.operators.positions import number_rows

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


_numbered: dict = {}


class Inputs:
    """The given tables, and views of them. Row-numbered views are written once
    per session and folder, as an ingest step, and then read like any table."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def once(self, name: str, build) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.dir, name)
        if key not in _numbered:
            _numbered[key] = build()
        return _numbered[key]

    def orders_n(self) -> DataFrame:
        """orders with row_id; some prices and priorities are missing."""

        def build():
            o = self.table("orders")
            return number_rows(
                o.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")))
                .withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority"))),
                ["o_orderkey"],
            )

        return self.once("orders_n", build)

    def orders_pair(self) -> DataFrame:
        """x and y miss values in different rows; c is constant."""
        o = self.table("orders")
        return o.select(
            "o_orderkey",
            F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("x"),
            F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey").cast("double")).alias("y"),
            F.lit(5.0).alias("c"),
        )

    def signed(self) -> DataFrame:
        """Balances of either sign with row_id; some zero, some missing."""

        def build():
            bal = (
                F.when(F.col("c_custkey") % 13 == 0, F.lit(None).cast("double"))
                .when(F.col("c_custkey") % 17 == 0, F.lit(0.0))
                .otherwise(F.col("c_acctbal"))
            )
            # every other balance is negated so both signs are frequent
            sign = F.when(F.col("c_custkey") % 2 == 0, F.lit(-1.0)).otherwise(F.lit(1.0))
            return number_rows(
                self.table("customer").select("c_custkey", (bal * sign).alias("balance")), ["c_custkey"]
            )

        return self.once("signed", build)

    def flat(self) -> DataFrame:
        """supplier with a constant and an all-missing column."""
        return self.table("supplier").select(
            "s_suppkey", "s_nationkey", "s_acctbal",
            F.lit(5.0).alias("five"), F.lit(None).cast("double").alias("nothing"),
        )

    def ties(self) -> DataFrame:
        """part by key: sizes repeat often."""
        return self.once(
            "ties",
            lambda: number_rows(self.table("part").select("p_partkey", "p_size", "p_retailprice"), ["p_partkey"]),
        )

    def rows_num(self) -> DataFrame:
        """lineitem's four measures; one of them missing in some rows."""
        k = F.col("l_orderkey") + F.col("l_linenumber")
        return self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_linenumber",
            "l_quantity",
            F.when(k % 9 != 0, F.col("l_extendedprice")).alias("l_extendedprice"),
            F.when(k % 9 != 1, F.col("l_discount")).alias("l_discount"),
            "l_tax",
        )

    def cell_requests(self, n_cols: int = 6) -> DataFrame:
        """One (row, col) request per customer, some outside the table."""
        k = F.col("c_custkey")
        return self.table("customer").select(
            k.alias("request_id"), (k * 11 - 3).alias("row"), (k % (n_cols + 2) - 1).cast("int").alias("col")
        )

    def corpus_li(self) -> DataFrame:
        """lineitem split into one table per supplier, with row_id inside each."""

        def build():
            li = self.table("lineitem")
            order = li.columns
            k = F.col("l_orderkey") + F.col("l_linenumber")
            columns = [
                "l_linenumber", F.when(k % 9 != 0, F.col("l_quantity")).alias("l_quantity"),
                "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_returnflag",
            ]
            # the number of the supplier moves and is compared; the table's name is made of it afterwards
            numbered = number_rows(li, order, ["l_suppkey"], keep=["l_suppkey", *columns])
            name = F.concat(F.lit("supplier_"), F.col("l_suppkey"), F.lit(".parquet"))
            return numbered.select(name.alias("table_id"), "row_id", *numbered.columns[1:-1])

        return self.once("corpus_li", build)


# ------------------------------------------------------------------ the same views in SQL
ORDERS_N = """orders_n AS (
  SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id, o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice, o_orderdate,
    CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS o_orderpriority
  FROM orders)"""
ORDERS_PAIR = """orders_pair AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS x,
    CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey::DOUBLE END AS y, 5.0::DOUBLE AS c FROM orders)"""
SIGNED = """signed AS (
  SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS row_id, c_custkey,
    CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN 0.0::DOUBLE ELSE c_acctbal END
      * CASE WHEN c_custkey % 2 = 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS balance
  FROM customer)"""
FLAT = """flat AS (SELECT s_suppkey, s_nationkey, s_acctbal, 5.0::DOUBLE AS five, NULL::DOUBLE AS nothing FROM supplier)"""
TIES = """ties AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS row_id, p_partkey, p_size, p_retailprice FROM part)"""
ROWS_NUM = """rows_num AS (
  SELECT l_orderkey, l_partkey, l_linenumber, l_quantity,
    CASE WHEN (l_orderkey + l_linenumber) % 9 <> 0 THEN l_extendedprice END AS l_extendedprice,
    CASE WHEN (l_orderkey + l_linenumber) % 9 <> 1 THEN l_discount END AS l_discount, l_tax FROM lineitem)"""
ROW_LIST = ROWS_NUM + """, row_list AS (
  SELECT l_orderkey, l_partkey, l_linenumber, [l_quantity, l_extendedprice, l_discount, l_tax] AS a,
    list_filter([l_quantity, l_extendedprice, l_discount, l_tax], lambda x: x IS NOT NULL) AS nn FROM rows_num)"""
CELL_REQUESTS = """cell_requests AS (
  SELECT c_custkey AS request_id, c_custkey * 11 - 3 AS row, (c_custkey % 8 - 1)::INT AS col FROM customer)"""
CORPUS_LI = """corpus_li AS (
  SELECT 'supplier_' || l_suppkey || '.parquet' AS table_id,
    row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
      l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS row_id,
    l_linenumber, CASE WHEN (l_orderkey + l_linenumber) % 9 <> 0 THEN l_quantity END AS l_quantity,
    l_extendedprice, l_discount, l_tax, l_linestatus, l_returnflag
  FROM lineitem)"""
#: cells of orders_n; numbers in v_num, everything else in v_str
ORDER_CELLS = ORDERS_N + """, order_cells AS MATERIALIZED (
  SELECT row_id, 0 AS col, o_orderkey::DOUBLE AS v_num, NULL::VARCHAR AS v_str FROM orders_n
  UNION ALL SELECT row_id, 1, o_custkey::DOUBLE, NULL FROM orders_n
  UNION ALL SELECT row_id, 2, NULL, o_orderstatus FROM orders_n
  UNION ALL SELECT row_id, 3, o_totalprice, NULL FROM orders_n
  UNION ALL SELECT row_id, 4, NULL, o_orderdate::VARCHAR FROM orders_n
  UNION ALL SELECT row_id, 5, NULL, o_orderpriority FROM orders_n)"""
