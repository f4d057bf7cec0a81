"""The panel vocabulary expressed over the star-schema tables.

period = ship year, group = supplier nation, member = part, minutes =
quantity. Each function has a SQL fragment of the same name for the twins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.columns import sum_or_zero
from panelspark.operators.panel import group_sums, impute_median, share_of_group, concentration, top_k, wins_by_group
from panelspark.sources import table_reader

TOP = 8
ROW_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
SUMMED = ["mins", "price", "disc", "tax", "made", "tried"]


def box(spark: SparkSession, sf: str) -> DataFrame:
    """One fact per line: period, group, member and its measures."""
    t = table_reader(spark, sf)
    lines, supplier = t("lineitem"), t("supplier").select("s_suppkey", "s_nationkey")
    period = F.year("l_shipdate")
    return (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            period.alias("period"),
            F.col("s_nationkey").alias("grp"),
            F.col("l_partkey").alias("member"),
            F.col("l_quantity").alias("mins"),
            F.col("l_extendedprice").alias("price"),
            (F.col("l_extendedprice") * F.col("l_discount")).alias("disc"),
            (F.col("l_extendedprice") * F.col("l_tax")).alias("tax"),
            (F.col("l_returnflag") == "R").cast("int").alias("made"),
            (F.col("l_linestatus") == "F").cast("int").alias("tried"),
            F.col("l_returnflag").alias("flag"),
        )
    )


def members(spark: SparkSession, sf: str) -> DataFrame:
    return group_sums(box(spark, sf), ["period", "grp", "member"], SUMMED)


def top_members(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(members(spark, sf), ["period", "grp"], "mins", TOP, ["member"])


def pay(spark: SparkSession, sf: str) -> DataFrame:
    """Salary of a member in a group and period, known only for some."""
    paid = box(spark, sf).filter("flag = 'A'")
    return paid.groupBy("period", "grp", "member").agg(F.sum("price").alias("salary"))


def shares(spark: SparkSession, sf: str) -> DataFrame:
    """Top members with imputed salary, salary share and the group's concentration."""
    keys = ["period", "grp"]
    # the salary is one more sum of the members' own aggregate: one scan and one shuffle
    paid = box(spark, sf).withColumn("salary", F.when(F.col("flag") == "A", F.col("price")))
    sums = paid.groupBy(*keys, "member").agg(*[sum_or_zero(c).alias(c) for c in SUMMED], F.sum("salary").alias("salary"))
    joined = top_k(sums, keys, "mins", TOP, ["member"])
    filled = impute_median(joined, keys, "salary", bounded_groups=True)
    shared = share_of_group(filled, keys, "salary", "share", bounded_groups=True)
    return concentration(shared, keys, "share", "hhi", bounded_groups=True)


def games(spark: SparkSession, sf: str) -> DataFrame:
    """One game per line: home = supplier nation, visitor = customer nation."""
    t = table_reader(spark, sf)
    return (
        t("lineitem")
        .select("l_orderkey", "l_suppkey", "l_shipdate", "l_linestatus")
        .join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.year("l_shipdate").alias("period"),
            F.col("s_nationkey").alias("home"),
            F.col("c_nationkey").alias("visitor"),
            (F.col("l_linestatus") == "F").cast("int").alias("home_wins"),
        )
    )


def wins(spark: SparkSession, sf: str) -> DataFrame:
    return wins_by_group(games(spark, sf), "home", "visitor", "home_wins", "period").withColumnRenamed(
        "group_id", "grp"
    )


SQL_BOX = """box AS (
  SELECT year(l_shipdate) AS period, s_nationkey AS grp, l_partkey AS member, l_quantity AS mins,
         l_extendedprice AS price, l_extendedprice * l_discount AS disc, l_extendedprice * l_tax AS tax,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS made,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS tried, l_returnflag AS flag
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""

SQL_MEMBERS = (
    SQL_BOX
    + """,
members AS (
  SELECT period, grp, member, sum(mins) AS mins, sum(price) AS price, sum(disc) AS disc, sum(tax) AS tax,
         CAST(sum(made) AS DOUBLE) AS made, CAST(sum(tried) AS DOUBLE) AS tried
  FROM box GROUP BY period, grp, member)"""
)

SQL_TOP = (
    SQL_MEMBERS
    + f""",
top AS (
  SELECT * FROM members
  QUALIFY row_number() OVER (PARTITION BY period, grp ORDER BY mins DESC, member) <= {TOP})"""
)

SQL_SHARES = (
    SQL_TOP
    + """,
pay AS (SELECT period, grp, member, sum(price) AS salary FROM box WHERE flag = 'A' GROUP BY period, grp, member),
filled AS (
  SELECT top.*, coalesce(salary, median(salary) OVER (PARTITION BY period, grp)) AS salary
  FROM top LEFT JOIN pay USING (period, grp, member)),
shared AS (SELECT *, salary / sum(salary) OVER (PARTITION BY period, grp) * 100 AS share FROM filled),
shares AS (SELECT *, sum(share * share) OVER (PARTITION BY period, grp) AS hhi FROM shared)"""
)

SQL_GAMES = """games AS (
  SELECT year(l_shipdate) AS period, s_nationkey AS home, c_nationkey AS visitor,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS home_wins
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey),
decided AS (SELECT *, CASE WHEN home_wins = 1 THEN home ELSE visitor END AS winner FROM games),
wins AS (
  SELECT period, grp, sum(CASE WHEN winner = grp THEN 1 ELSE 0 END) AS wins FROM (
    SELECT period, winner, home AS grp FROM decided
    UNION ALL
    SELECT period, winner, visitor AS grp FROM decided)
  GROUP BY period, grp)"""
