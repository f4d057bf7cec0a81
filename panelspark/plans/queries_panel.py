"""Registered queries: scans, cleaning, joins, aggregates, windows, reshapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions import columns as C
from panelspark.operators import clean, explore, gram, panel
from panelspark.plans import mapping as M
from panelspark.plans.registry import query
from panelspark.session import scratch_path
from panelspark.sources import table_reader
from panelspark.sources.readers import literal_table, read_delimited

KEYS = ["period", "grp"]


def rounded(df, digits: int, *columns: str):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- scans and projections ---------------------------------------------------


@query(
    "delimited_files",
    """WITH labels(region, label) AS (VALUES (0, 'north'), (1, 'east'), (2, 'south'), (3, 'west')),
       rows AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_nationkey END AS nation,
                       concat('Supplier "', s_suppkey, '", Ltd') AS name FROM supplier)
       SELECT id, nation, name, coalesce(label, 'none') AS label FROM rows LEFT JOIN labels ON region = nation WHERE id >= 3""",
)
def delimited_files(spark, sf):
    """A table written as delimited files with other columns, blanks and quotes, read by the
    names in their header, filtered at the scan, and labelled from a literal table."""
    supplier = table_reader(spark, sf)("supplier")
    path = scratch_path(spark, "delimited")
    supplier.select(
        F.lit("x").alias("extra"),
        F.concat(F.lit('Supplier "'), F.col("s_suppkey"), F.lit('", Ltd')).alias("name"),
        F.when(F.col("s_suppkey") % 7 != 0, F.col("s_nationkey")).alias("nation"),
        F.col("s_suppkey").alias("id"),
        F.col("s_acctbal").alias("other"),
    ).write.option("header", True).option("escape", '"').csv(path)
    schema = spark.createDataFrame([], f"id {supplier.schema['s_suppkey'].dataType.simpleString()}, nation int, name string").schema
    rows = read_delimited(spark, path, schema, where="id >= 3")
    labels = literal_table(spark, {"nation": [0, 1, 2, 3], "label": ["north", "east", "south", "west"]}, "nation int, label string")
    return rows.join(labels, "nation", "left").select("id", "nation", "name", F.coalesce("label", F.lit("none")).alias("label"))


@query(
    "scan_project",
    """SELECT l_orderkey AS game, l_partkey AS member, l_quantity AS mins, l_extendedprice AS price,
              round(l_extendedprice * (1 - l_discount), 4) AS net, l_tax + l_discount AS rate
       FROM lineitem WHERE l_quantity >= 10 AND l_quantity <= 40 AND l_returnflag <> 'N'""",
)
def scan_project(spark, sf):
    lines = table_reader(spark, sf)("lineitem")
    kept = lines.filter("l_quantity >= 10 AND l_quantity <= 40 AND l_returnflag <> 'N'")
    span = C.cols_between(kept, "l_quantity", "l_discount")
    return (
        kept.select("l_orderkey", "l_partkey", *span, "l_tax")
        .withColumns(
            {
                "net": F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4),
                "rate": F.col("l_tax") + F.col("l_discount"),
            }
        )
        .withColumnsRenamed(
            {"l_orderkey": "game", "l_partkey": "member", "l_quantity": "mins", "l_extendedprice": "price"}
        )
        .drop("l_discount", "l_tax")
    )


@query(
    "member_period_sums",
    f"""WITH {M.SQL_MEMBERS}
        SELECT period, grp, member, round(mins, 4) AS mins, round(price, 4) AS price, round(disc, 4) AS disc,
               round(tax, 4) AS tax, made, tried FROM members""",
)
def member_period_sums(spark, sf):
    return rounded(M.members(spark, sf), 4, "mins", "price", "disc", "tax")


@query(
    "strict_sum",
    """SELECT l_partkey AS member, CASE WHEN count(x) = count(*) THEN round(sum(x), 4) END AS strict_total,
              round(coalesce(sum(x), 0), 4) AS loose_total
       FROM (SELECT l_partkey, CASE WHEN l_returnflag <> 'N' THEN l_extendedprice END AS x FROM lineitem)
       GROUP BY l_partkey""",
)
def strict_sum(spark, sf):
    lines = table_reader(spark, sf)("lineitem")
    x = F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice"))
    return lines.groupBy(F.col("l_partkey").alias("member")).agg(
        F.round(C.strict_sum(x), 4).alias("strict_total"), F.round(C.sum_or_zero(x), 4).alias("loose_total")
    )


@query(
    "table_counts",
    """SELECT count(*) AS n_rows, 11 AS n_columns, count(DISTINCT l_orderkey) AS n_orders FROM lineitem""",
)
def table_counts(spark, sf):
    lines = table_reader(spark, sf)("lineitem")
    orders = panel.distinct_keys(lines, "l_orderkey").agg(F.count(F.lit(1)).alias("n")).scalar()
    return explore.table_counts(lines).withColumn("n_orders", orders)


# --- top-k, wins, shares -------------------------------------------------------


@query(
    "top8_members",
    f"WITH {M.SQL_TOP} SELECT period, grp, member, mins, round(price, 4) AS price, made, tried FROM top",
)
def top8_members(spark, sf):
    top = M.top_members(spark, sf).select(*KEYS, "member", "mins", "price", "made", "tried")
    return rounded(top, 4, "price")


@query(
    "topk_coverage",
    f"""WITH {M.SQL_TOP},
        covered AS (SELECT period, grp, sum(mins) AS c FROM top GROUP BY period, grp),
        total AS (SELECT period, grp, sum(mins) AS t FROM members GROUP BY period, grp)
        SELECT period, round(avg(c / t * 100), 6) AS share FROM covered JOIN total USING (period, grp)
        GROUP BY period""",
)
def topk_coverage(spark, sf):
    return rounded(panel.topk_coverage(M.members(spark, sf), "period", "grp", "mins", M.TOP, ["member"]), 6, "share")


@query("wins_by_group", f"WITH {M.SQL_GAMES} SELECT period, grp, CAST(wins AS BIGINT) AS wins FROM wins")
def wins_by_group(spark, sf):
    return M.wins(spark, sf)


@query(
    "salary_share_hhi",
    f"""WITH {M.SQL_SHARES}
        SELECT period, grp, member, round(salary, 4) AS salary, round(share, 6) AS share, round(hhi, 4) AS hhi
        FROM shares""",
)
def salary_share_hhi(spark, sf):
    out = M.shares(spark, sf).select(*KEYS, "member", "salary", "share", "hhi")
    return out.withColumns({"salary": F.round("salary", 4), "share": F.round("share", 6), "hhi": F.round("hhi", 4)})


@query(
    "share_whole_group",
    """WITH s AS (SELECT c_nationkey AS grp, c_custkey AS member,
                         c_acctbal / sum(c_acctbal) OVER (PARTITION BY c_nationkey) * 100 AS share FROM customer)
       SELECT grp, member, round(share, 6) AS share,
              round(sum(share * share) OVER (PARTITION BY grp), 4) AS hhi FROM s""",
)
def share_whole_group(spark, sf):
    """Shares over groups of any size: aggregates joined back, no window over a group."""
    rows = table_reader(spark, sf)("customer").select(
        F.col("c_nationkey").alias("grp"), F.col("c_custkey").alias("member"), "c_acctbal"
    )
    shared = panel.share_of_group(rows, ["grp"], "c_acctbal", "share")
    return panel.concentration(shared, ["grp"], "share").select(
        "grp", "member", F.round("share", 6).alias("share"), F.round("hhi", 4).alias("hhi")
    )


@query(
    "impute_group_median",
    """WITH v AS (SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events)
       SELECT event_id, user_id, round(coalesce(value, median(value) OVER (PARTITION BY user_id)), 6) AS value
       FROM v""",
)
def impute_group_median(spark, sf):
    """Group medians over groups of any size."""
    rows = table_reader(spark, sf)("events").select(
        "event_id", "user_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    )
    return rounded(panel.impute_median(rows, ["user_id"], "value"), 6, "value")


@query(
    "group_bill",
    f"""WITH {M.SQL_BOX}, pay AS (
          SELECT period, grp, member, sum(CASE WHEN flag = 'A' THEN price END) AS salary
          FROM box GROUP BY period, grp, member)
        SELECT period, grp, round(sum(salary), 4) AS known_bill,
               CASE WHEN count(salary) = count(*) THEN round(sum(salary), 4) END AS bill, count(*) AS n
        FROM pay GROUP BY period, grp""",
)
def group_bill(spark, sf):
    """Salary bill per group: null when any member's salary is unknown."""
    paid = F.sum(F.when(F.col("flag") == "A", F.col("price")))
    pay = M.box(spark, sf).groupBy(*KEYS, "member").agg(paid.alias("salary"))
    return pay.groupBy(*KEYS).agg(
        F.round(F.sum("salary"), 4).alias("known_bill"),
        F.round(C.strict_sum("salary"), 4).alias("bill"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    "carry_back",
    """SELECT event_id, user_id, round(first_value(v IGNORE NULLS) OVER (
                PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 6) AS value
       FROM (SELECT *, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)""",
)
def carry_back(spark, sf):
    """Next known value per user, filled day by day so a busy user is split."""
    rows = table_reader(spark, sf)("events").select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    )
    filled = panel.carry_back(rows, ["user_id"], ["ts", "event_id"], "value", chunk=F.to_date("ts"))
    return filled.select("event_id", "user_id", F.round("value", 6).alias("value"))


@query(
    "salary_span",
    """WITH orders_y AS (SELECT o_custkey AS member, year(o_orderdate) AS season_start,
                                year(o_orderdate) + 1 AS season_end, o_totalprice FROM orders),
       contract AS (SELECT member, season_start, season_end, sum(o_totalprice) AS salary
                    FROM orders_y GROUP BY ALL),
       long AS (SELECT DISTINCT member, season FROM
                (SELECT member, season_start AS season FROM contract UNION ALL
                 SELECT member, season_end AS season FROM contract)),
       joined AS (SELECT long.member, long.season, salary FROM long LEFT JOIN contract
                  ON long.member = contract.member AND long.season = contract.season_end)
       SELECT member, season, round(first_value(salary IGNORE NULLS) OVER (
                PARTITION BY member ORDER BY season ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 4) AS salary
       FROM joined""",
)
def salary_span(spark, sf):
    """Contracts spread over their first and last period; earlier gaps take the next salary."""
    orders = table_reader(spark, sf)("orders")
    start = F.year("o_orderdate")
    contract = (
        orders.groupBy(
            F.col("o_custkey").alias("member"), start.alias("season_start"), (start + 1).alias("season_end")
        )
        .agg(F.sum("o_totalprice").alias("salary"))
    )
    span = (
        contract.unpivot(["member"], ["season_start", "season_end"], "season_type", "season")
        .select("member", "season")
        .distinct()
    )
    joined = clean.left_join_on(
        span, contract.select("member", "season_end", "salary"), {"member": "member", "season": "season_end"}
    )
    filled = panel.carry_back(joined, ["member"], ["season"], "salary")
    return rounded(filled, 4, "salary")


# --- keys and codes --------------------------------------------------------------

# An in-line code map for the test tables.
SEGMENT_CODES = {"AUTOMOBILE": "AUT", "BUILDING": "BLD", "FURNITURE": "FUR", "HOUSEHOLD": "HOM", "MACHINERY": "AUT"}
PRIORITY_MAP = {"1-URGENT": "HIGH", "2-HIGH": "HIGH", "5-LOW": "LOW"}
NAME_REPAIRS = {f"NATION_{i} ": f"NATION_{i}" for i in range(25)}


def _sql_case(column: str, pairs: dict[str, str], otherwise: str) -> str:
    arms = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in pairs.items())
    return f"CASE {column} {arms} ELSE {otherwise} END"


@query(
    "conform_codes",
    f"""SELECT {_sql_case("o_orderpriority", PRIORITY_MAP, "o_orderpriority")} AS priority, count(*) AS n,
               round(sum(o_totalprice), 4) AS total FROM orders GROUP BY 1""",
)
def conform_codes(spark, sf):
    orders = clean.conform_codes(table_reader(spark, sf)("orders"), "o_orderpriority", PRIORITY_MAP)
    return orders.groupBy(F.col("o_orderpriority").alias("priority")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 4).alias("total")
    )


@query(
    "code_lookup",
    f"""SELECT c_custkey AS member, {_sql_case("c_mktsegment", SEGMENT_CODES, "NULL")} AS code,
               n_name AS nation, r_name AS region
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def code_lookup(spark, sf):
    t = table_reader(spark, sf)
    coded = clean.code_lookup(t("customer"), "c_mktsegment", SEGMENT_CODES, "code")
    named = clean.left_join_on(coded, t("nation"), {"c_nationkey": "n_nationkey"})
    named = clean.left_join_on(named, t("region"), {"n_regionkey": "r_regionkey"})
    return named.select(
        F.col("c_custkey").alias("member"), "code", F.col("n_name").alias("nation"), F.col("r_name").alias("region")
    )


@query(
    "recode_table",
    """SELECT p_partkey AS member, coalesce(s_name, p_name) AS label
       FROM part LEFT JOIN (SELECT s_suppkey, s_name FROM supplier) s ON p_partkey = s.s_suppkey""",
)
def recode_table(spark, sf):
    """Recode from a dictionary table of any size, others passing through."""
    t = table_reader(spark, sf)
    names = t("supplier").select(F.col("s_suppkey").cast("string").alias("old"), F.col("s_name").alias("new"))
    rows = t("part").withColumn("label", F.col("p_partkey").cast("string"))
    coded = clean.recode_from_table(rows, "label", names, "old", "new")
    changed = F.col("label") != F.col("p_partkey").cast("string")
    return coded.select(
        F.col("p_partkey").alias("member"), F.when(changed, F.col("label")).otherwise(F.col("p_name")).alias("label")
    )


@query(
    "unmatched_keys",
    """SELECT DISTINCT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
)
def unmatched_keys(spark, sf):
    t = table_reader(spark, sf)
    return clean.unmatched_keys(t("documents"), t("labels"), "doc_id")


@query(
    "key_repair",
    """WITH keyed AS (
         SELECT c_custkey AS member, CASE WHEN c_custkey % 3 = 0 THEN concat('NATION_', c_nationkey, ' ')
                WHEN c_custkey % 7 = 0 THEN concat('LOST_', c_nationkey) ELSE concat('NATION_', c_nationkey) END AS n
         FROM customer),
       repaired AS (SELECT member, CASE WHEN n IN (SELECT n_name FROM nation) THEN n
                           WHEN n LIKE 'NATION_% ' THEN rtrim(n) ELSE n END AS name FROM keyed)
       SELECT member, name, n_nationkey AS id FROM repaired JOIN nation ON name = n_name""",
)
def key_repair(spark, sf):
    """Match by name, repair the names that do not match, match again, drop the rest."""
    t = table_reader(spark, sf)
    nation = F.col("c_nationkey").cast("string")
    member = F.col("c_custkey")
    name = (
        F.when(member % 3 == 0, F.concat(F.lit("NATION_"), nation, F.lit(" ")))
        .when(member % 7 == 0, F.concat(F.lit("LOST_"), nation))
        .otherwise(F.concat(F.lit("NATION_"), nation))
    )
    keyed = t("customer").select(member.alias("member"), name.alias("name"))
    dim = t("nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("id"))
    return clean.repair_and_match(keyed, dim, "name", NAME_REPAIRS)


@query(
    "shifted_period_join",
    f"""WITH {M.SQL_MEMBERS},
        stats AS (SELECT period - 1 AS period, grp, member, price AS next_price FROM members)
        SELECT period, grp, member, round(price, 4) AS price, round(next_price, 4) AS next_price
        FROM members LEFT JOIN stats USING (period, grp, member)""",
)
def shifted_period_join(spark, sf):
    rows = M.members(spark, sf).select(*KEYS, "member", "price")
    stats = rows.withColumnRenamed("price", "next_price")
    return rounded(
        panel.shifted_period_join(rows, stats, "period", ["grp", "member"], -1), 4, "price", "next_price"
    )


# --- first rows and distinct keys ----------------------------------------------------


@query(
    "first_per_group",
    """SELECT user_id, arg_min(event_type, ts) AS event_type, round(arg_min(value, ts), 6) AS value
       FROM events GROUP BY user_id""",
)
def first_per_group(spark, sf):
    events = table_reader(spark, sf)("events")
    return rounded(
        panel.first_per_group(events, ["user_id"], ["event_type", "value"], ["ts", "event_id"]), 6, "value"
    )


@query(
    "distinct_keep_first",
    """SELECT o_custkey, o_orderkey, o_orderstatus, round(o_totalprice, 4) AS o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
)
def distinct_keep_first(spark, sf):
    orders = table_reader(spark, sf)("orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    first = panel.keep_first_row(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return rounded(first.drop("o_orderdate"), 4, "o_totalprice")


@query(
    "distinct_keys",
    "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem",
)
def distinct_keys(spark, sf):
    return panel.distinct_keys(table_reader(spark, sf)("lineitem"), "l_suppkey", "l_returnflag", "l_linestatus")


# --- scalar functions ------------------------------------------------------------------

RATES = ["price", "disc", "tax"]


@query(
    "rates_and_percentages",
    f"""WITH {M.SQL_MEMBERS}
        SELECT period, grp, member, {", ".join(f"round({c}, 4) / mins * 10 AS {c}_rate" for c in RATES)},
               round(coalesce(made / nullif(tried, 0) * 100, 0), 6) AS made_pct FROM members""",
)
def rates_and_percentages(spark, sf):
    rows = M.members(spark, sf)
    return rows.select(
        *KEYS,
        "member",
        *[C.per_unit(F.round(c, 4), "mins").alias(f"{c}_rate") for c in RATES],
        F.round(C.safe_pct("made", "tried"), 6).alias("made_pct"),
    )


@query(
    "duration_minutes",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE round(
                TRY_CAST(split_part(d, ':', 1) AS DOUBLE) + TRY_CAST(split_part(d, ':', 2) AS DOUBLE) / 60, 6) END AS mins
       FROM (SELECT event_id, event_type, concat(minute(ts), ':', second(ts)) AS d FROM events)""",
)
def duration_minutes(spark, sf):
    clock = F.concat(F.minute("ts").cast("string"), F.lit(":"), F.second("ts").cast("string"))
    text = F.when(F.col("event_type") != "error", clock).otherwise("")
    return table_reader(spark, sf)("events").select(
        "event_id", F.round(C.duration_minutes(text), 6).alias("mins")
    )


@query(
    "scalar_math",
    """SELECT c_custkey AS member, CAST(c_nationkey AS VARCHAR) AS level, round(ln(abs(c_acctbal) + 1), 6) AS lg,
              round(sqrt(abs(c_acctbal)), 6) AS root, round(pow(c_acctbal / 100, 2), 6) AS square,
              round(1.959963984540054 * c_acctbal, 3) AS upper,
              CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal >= 0 THEN 'credit' END AS side,
              CAST(c_custkey + c_nationkey AS BIGINT) AS total
       FROM customer""",
)
def scalar_math(spark, sf):
    from panelspark.functions.dist import normal_ppf

    bal = F.col("c_acctbal")
    return table_reader(spark, sf)("customer").select(
        F.col("c_custkey").alias("member"),
        F.col("c_nationkey").cast("string").alias("level"),
        F.round(F.log(F.abs(bal) + 1), 6).alias("lg"),
        F.round(F.sqrt(F.abs(bal)), 6).alias("root"),
        F.round(F.pow(bal / 100, F.lit(2)), 6).alias("square"),
        F.round(F.lit(normal_ppf(0.975)) * bal, 3).alias("upper"),
        C.conditional(bal < 0, F.lit("debt"), F.lit("credit")).alias("side"),
        C.row_sum(["c_custkey", "c_nationkey"]).alias("total"),
    )


@query(
    "string_clean",
    r"""SELECT page_id, regexp_replace(url, '/+', '', 'g') AS flat,
               regexp_replace(concat(url, '**'), '\*+$', '') AS bare,
               regexp_matches(url, 'example|http') AS hit, concat('page_', page_id) AS label
        FROM pages""",
)
def string_clean(spark, sf):
    return table_reader(spark, sf)("pages").select(
        "page_id",
        C.strip_slashes("url").alias("flat"),
        C.strip_suffix(F.concat("url", F.lit("**"))).alias("bare"),
        F.col("url").rlike("example|http").alias("hit"),
        F.concat(F.lit("page_"), F.col("page_id").cast("string")).alias("label"),
    )


@query(
    "complete_cases",
    """SELECT d.doc_id, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
       WHERE quality IS NOT NULL AND toxic IS NOT NULL AND n_chars IS NOT NULL""",
)
def complete_cases(spark, sf):
    t = table_reader(spark, sf)
    joined = clean.left_join_on(t("documents").select("doc_id", "n_chars"), t("labels"), ["doc_id"])
    return clean.complete_cases(joined)


@query(
    "membership",
    """SELECT event_id, event_type FROM events
       WHERE event_type IN ('click', 'view', 'purchase') AND NOT (user_id IN (1, 2, 3)) AND value IS NOT NULL""",
)
def membership(spark, sf):
    events = table_reader(spark, sf)("events")
    return events.filter(
        F.col("event_type").isin("click", "view", "purchase")
        & ~F.col("user_id").isin(1, 2, 3)
        & F.col("value").isNotNull()
    ).select("event_id", "event_type")


@query(
    "period_union",
    f"""WITH {M.SQL_GAMES}, {M.SQL_MEMBERS}
        SELECT period, grp, 'wins' AS measure, CAST(wins AS DOUBLE) AS value FROM wins
        UNION ALL BY NAME
        SELECT 'mins' AS measure, round(sum(mins), 4) AS value, grp, period FROM members GROUP BY period, grp""",
)
def period_union(spark, sf):
    wins = M.wins(spark, sf).select(*KEYS, F.lit("wins").alias("measure"), F.col("wins").cast("double").alias("value"))
    mins = (
        M.members(spark, sf)
        .groupBy(*KEYS)
        .agg(F.round(F.sum("mins"), 4).alias("value"))
        .select("value", "grp", "period", F.lit("mins").alias("measure"))
    )
    return clean.union_by_name(wins, mins)


# --- scaling, ranks, reshapes --------------------------------------------------------------


@query(
    "zscore",
    f"""WITH {M.SQL_MEMBERS}
        SELECT period, grp, member,
               {", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) + 0.0 AS {c}_z" for c in ["mins", *RATES])}
        FROM members""",
)
def zscore(spark, sf):
    columns = ["mins", *RATES]
    scaled = panel.zscore(M.members(spark, sf), columns, suffix="_z")
    return scaled.select(*KEYS, "member", *[(F.round(f"{c}_z", 6) + F.lit(0.0)).alias(f"{c}_z") for c in columns])


@query(
    "hhi_zscore",
    f"""WITH {M.SQL_SHARES}, one AS (SELECT period, grp, arg_min(hhi, member) AS hhi FROM shares GROUP BY period, grp)
        SELECT period, grp, round((hhi - avg(hhi) OVER ()) / stddev_samp(hhi) OVER (), 6) + 0.0 AS z FROM one""",
)
def hhi_zscore(spark, sf):
    one = panel.first_per_group(M.shares(spark, sf), KEYS, ["hhi"], ["member"])
    return panel.zscore(one, ["hhi"]).select(*KEYS, (F.round("hhi", 6) + F.lit(0.0)).alias("z"))


LABELS = [f"player_{i}" for i in range(1, M.TOP + 1)]
SQL_RANKED = (
    M.SQL_SHARES
    + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY period, grp ORDER BY share DESC NULLS LAST, member) AS rk FROM shares)"""
)


@query(
    "rank_wide",
    f"""WITH {SQL_RANKED} SELECT period, grp, round(max(hhi), 4) AS hhi,
        {", ".join(f"max(CASE WHEN rk = {i} THEN mins END) AS mins_player_{i}" for i in range(1, 9))},
        {", ".join(f"round(max(CASE WHEN rk = {i} THEN price END), 4) AS price_player_{i}" for i in range(1, 9))}
        FROM ranked GROUP BY period, grp""",
)
def rank_wide(spark, sf):
    rows = rounded(M.shares(spark, sf), 4, "hhi", "price")
    ranked = panel.rank_labels(rows, KEYS, "share", M.TOP, ["member"])
    return panel.rank_wide(ranked, KEYS, "rank", LABELS, ["mins", "price"], carry=["hhi"])


WIDE_TERMS = [f"{v}_player_{i}" for v in ("mins", "price") for i in range(1, 9)]


def wide_rows(spark, sf):
    """The wide design: a group and period per row, two measures of each ranked member, folds.

    The odd divisor keeps sums of products off the edges of rounding."""
    rows = M.shares(spark, sf).withColumn("price", F.col("price") / 977)
    ranked = panel.rank_labels(rows, KEYS, "share", M.TOP, ["member"])
    wide = panel.rank_wide(ranked, KEYS, "rank", LABELS, ["mins", "price"], carry=["hhi"])
    return gram.assign_folds(wide, KEYS, 3, "wide")


SQL_WIDE = f"""{SQL_RANKED},
wide AS (SELECT period, grp, max(hhi) AS hhi,
         {", ".join(f"max(CASE WHEN rk = {i} THEN mins END) AS mins_player_{i}" for i in range(1, 9))},
         {", ".join(f"max(CASE WHEN rk = {i} THEN price / 977 END) AS price_player_{i}" for i in range(1, 9))}
         FROM ranked GROUP BY period, grp),
design AS (SELECT *, 1.0 AS one,
           CAST(CAST(concat('0x', substr(md5(concat_ws('|', period, grp, 'wide')), 1, 8)) AS BIGINT) % 3 AS INTEGER) AS fold
           FROM wide WHERE {" AND ".join(f"{t} IS NOT NULL" for t in ["hhi", *WIDE_TERMS])}),
long AS ({" UNION ALL ".join(
    f"SELECT period, grp, fold, {i} AS at, '{n}' AS name, CAST({c} AS DOUBLE) AS value FROM design"
    for i, (n, c) in enumerate([("(Intercept)", "one"), *[(t, t) for t in WIDE_TERMS], ("hhi", "hhi")]))})"""


@query(
    "wide_gram",
    f"""WITH {SQL_WIDE}
        SELECT a.fold, a.name AS "left", b.name AS "right", round(sum(a.value * b.value), 2) AS value
        FROM long a JOIN long b ON a.period = b.period AND a.grp = b.grp AND a.at <= b.at GROUP BY a.fold, a.name, b.name""",
)
def wide_gram(spark, sf):
    """Moments of the wide design by fold: blocks of rows multiplied in tasks."""
    columns = [*WIDE_TERMS, "hhi"]
    named = gram.named_moments(gram.keyed_moments(wide_rows(spark, sf), columns, ["fold"]), columns, ["fold"])
    return rounded(named, 2, "value")


@query(
    "rank_share_band",
    f"""WITH {SQL_RANKED}, band AS (
          SELECT concat('player_', rk) AS rank, avg(share) AS mean, stddev_samp(share) AS sd FROM ranked GROUP BY rk)
        SELECT rank, round(mean, 6) AS mean, round(sd, 6) AS sd, round(mean + sd, 6) AS upper,
               round(mean - sd, 6) AS lower FROM band""",
)
def rank_share_band(spark, sf):
    ranked = panel.rank_labels(M.shares(spark, sf), KEYS, "share", M.TOP, ["member"])
    return rounded(explore.mean_band(ranked, ["rank"], "share"), 6, "mean", "sd", "upper", "lower")


@query(
    "unpivot_metrics",
    f"""WITH {M.SQL_SHARES}
        SELECT period, grp, member, metric, round(value, 6) AS value FROM (
          SELECT period, grp, member, 'mins' AS metric, mins AS value FROM shares UNION ALL
          SELECT period, grp, member, 'price', price FROM shares UNION ALL
          SELECT period, grp, member, 'disc', disc FROM shares)""",
)
def unpivot_metrics(spark, sf):
    long = explore.facet_long(M.shares(spark, sf), [*KEYS, "member"], ["mins", "price", "disc"])
    return rounded(long, 6, "value")


@query(
    "ranked_side_by_side",
    f"""WITH {M.SQL_MEMBERS}, a AS (SELECT grp, sum(mins) AS v FROM members GROUP BY grp),
        b AS (SELECT period, sum(price) AS v FROM members GROUP BY period),
        ra AS (SELECT row_number() OVER (ORDER BY v DESC) AS position, v FROM a ORDER BY v DESC LIMIT 8),
        rb AS (SELECT row_number() OVER (ORDER BY v DESC) AS position, v FROM b ORDER BY v DESC LIMIT 8)
        SELECT CAST(coalesce(ra.position, rb.position) AS INTEGER) AS position, round(ra.v, 4) AS group_mins,
               round(rb.v, 4) AS period_price
        FROM ra FULL JOIN rb ON ra.position = rb.position""",
)
def ranked_side_by_side(spark, sf):
    """The eight largest groups and periods, aligned by their rank."""
    rows = M.members(spark, sf)
    by_group = rows.groupBy("grp").agg(F.sum("mins").alias("v"))
    by_period = rows.groupBy("period").agg(F.sum("price").alias("v"))
    bound = panel.bind_by_rank({"group_mins": (by_group, "v"), "period_price": (by_period, "v")}, M.TOP)
    return rounded(bound, 4, "group_mins", "period_price")


# --- exploration -----------------------------------------------------------------------------


@query(
    "histogram",
    """WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) AS n FROM lineitem),
       b AS (SELECT least(CAST(floor((l_extendedprice - lo) / ((hi - lo) / 30)) AS INTEGER), 29) AS bin,
                    lo, hi, n FROM lineitem, e)
       SELECT bin, round(any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / 30), 4) AS "left",
              round(any_value(lo) + (bin + 1) * ((any_value(hi) - any_value(lo)) / 30), 4) AS "right",
              count(*) AS "count", round(count(*) / (any_value(n) * ((any_value(hi) - any_value(lo)) / 30)), 12) AS density
       FROM b GROUP BY bin""",
)
def histogram(spark, sf):
    out = explore.histogram(table_reader(spark, sf)("lineitem"), "l_extendedprice", 30)
    return rounded(rounded(out, 4, "left", "right"), 12, "density")


@query(
    "wins_histogram",
    f"""WITH {M.SQL_GAMES}, w AS (SELECT CAST(wins AS DOUBLE) AS x FROM wins),
        e AS (SELECT min(x) AS lo, max(x) AS hi FROM w)
        SELECT least(CAST(floor((x - lo) / ((hi - lo) / 30)) AS INTEGER), 29) AS bin, count(*) AS n
        FROM w, e GROUP BY 1""",
)
def wins_histogram(spark, sf):
    wins = M.wins(spark, sf)
    return explore.histogram(wins, "wins", 30).select("bin", F.col("count").alias("n"))


@query(
    "density_grid",
    f"""WITH {M.SQL_MEMBERS},
        e AS (SELECT min(price) AS lo, max(price) AS hi, count(*) AS n, stddev_samp(price) AS sd,
                     quantile_cont(price, 0.75) - quantile_cont(price, 0.25) AS iqr FROM members),
        h AS (SELECT *, 0.9 * least(sd, iqr / 1.34) * pow(n, -0.2) AS bw FROM e),
        spots AS (SELECT CAST(point AS INTEGER) AS point, lo + point * ((hi - lo) / 511) AS x, bw, n
                  FROM h, generate_series(0, 511) g(point))
        SELECT point, round(any_value(x), 4) AS x,
               round(sum(exp(-0.5 * ((x - price) / bw) * ((x - price) / bw)) / (n * bw * sqrt(2 * pi()))), 12) AS density
        FROM spots, members GROUP BY point""",
)
def density_grid(spark, sf):
    return rounded(rounded(explore.density_grid(M.members(spark, sf), "price"), 4, "x"), 12, "density")


@query(
    "facet_fit",
    f"""WITH {M.SQL_SHARES}, long AS (
          SELECT 'mins' AS metric, mins AS value, share FROM shares UNION ALL
          SELECT 'price', price, share FROM shares UNION ALL SELECT 'disc', disc, share FROM shares)
        SELECT metric, CAST(regr_count(share, value) AS BIGINT) AS "count", round(regr_slope(share, value), 8) AS slope,
               round(regr_intercept(share, value), 6) AS intercept, round(regr_r2(share, value), 8) AS r2,
               round(sqrt((regr_syy(share, value) - pow(regr_sxy(share, value), 2) / regr_sxx(share, value))
                          / (regr_count(share, value) - 2)), 6) AS sigma
        FROM long GROUP BY metric""",
)
def facet_fit(spark, sf):
    long = explore.facet_long(M.shares(spark, sf), ["share"], ["mins", "price", "disc"])
    fit = explore.facet_fit(long, "metric", "value", "share")
    fit = rounded(rounded(fit, 8, "slope", "r2"), 6, "intercept", "sigma")
    return fit.select("metric", "count", "slope", "intercept", "r2", "sigma")


@query(
    "facet_band",
    f"""WITH {M.SQL_SHARES}, long AS (
          SELECT 'mins' AS metric, mins AS value, share FROM shares UNION ALL
          SELECT 'price', price, share FROM shares UNION ALL SELECT 'disc', disc, share FROM shares),
        f AS (SELECT metric, CAST(regr_count(share, value) AS DOUBLE) AS n, regr_slope(share, value) AS b,
                     regr_intercept(share, value) AS a, regr_sxx(share, value) AS sxx, regr_syy(share, value) AS syy,
                     regr_sxy(share, value) AS sxy, regr_avgx(share, value) AS mx,
                     min(value) FILTER (share IS NOT NULL) AS lo, max(value) FILTER (share IS NOT NULL) AS hi,
                     CAST(1.959963984540054 AS DOUBLE) AS q
              FROM long GROUP BY metric),
        s AS (SELECT *, sqrt((syy - sxy * sxy / sxx) / (n - 2)) AS sigma, n - 2 AS v FROM f),
        t AS (SELECT *, q + (pow(q, 3) + q) / (4 * v) + (5 * pow(q, 5) + 16 * pow(q, 3) + 3 * q) / (96 * v * v)
                     + (3 * pow(q, 7) + 19 * pow(q, 5) + 17 * pow(q, 3) - 15 * q) / (384 * v * v * v) AS tq FROM s),
        g AS (SELECT *, lo + i * (hi - lo) / 79 AS x FROM t, generate_series(0, 79) r(i)),
        e AS (SELECT *, a + b * x AS fit, tq * sigma * sqrt(1 / n + (x - mx) * (x - mx) / sxx) AS half FROM g)
        SELECT metric, CAST(i AS INTEGER) AS point, round(x, 4) AS x, round(fit, 5) AS fit,
               round(fit - half, 5) AS lower, round(fit + half, 5) AS upper FROM e""",
)
def facet_band(spark, sf):
    """Fitted line and 95% band per metric, on 80 points each."""
    long = explore.facet_long(M.shares(spark, sf), ["share"], ["mins", "price", "disc"])
    band = explore.facet_band(explore.facet_fit(long, "metric", "value", "share"), "metric")
    return rounded(rounded(band, 4, "x"), 5, "fit", "lower", "upper")


@query(
    "fit_metrics",
    f"""WITH {M.SQL_MEMBERS}, p AS (SELECT period, price AS y, mins * 100.0 AS pred FROM members)
        SELECT period, count(*) AS n, round(pow(corr(y, pred), 2), 8) AS sq_corr,
               round(sqrt(avg(pow(y - pred, 2))), 4) AS rmse,
               round(sqrt(avg(pow(y - pred, 2))) / avg(y), 8) AS nrmse, round(sum(pow(y - pred, 2)) / 1e9, 4) AS ssr_g
        FROM p GROUP BY period""",
)
def fit_metrics(spark, sf):
    rows = M.members(spark, sf).select("period", F.col("price").alias("y"), (F.col("mins") * 100.0).alias("pred"))
    out = explore.fit_metrics(rows, "y", "pred", ["period"]).withColumn("ssr_g", F.round(F.col("ssr") / 1e9, 4))
    return rounded(rounded(out.drop("ssr"), 8, "sq_corr", "nrmse"), 4, "rmse")


SPREAD = ["mins", "price", "disc", "tax", "flat"]


@query(
    "varying_columns",
    f"""WITH {M.SQL_MEMBERS}, m AS (SELECT *, 1.0 AS flat FROM members)
        {" UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(stddev_samp({c}), 4) AS sd, stddev_samp({c}) > 0 AS varies FROM m" for c in SPREAD)}""",
)
def varying_columns(spark, sf):
    rows = M.members(spark, sf).withColumn("flat", F.lit(1.0))
    return rounded(explore.column_spread(rows, SPREAD), 4, "sd")


@query(
    "group_quantile",
    """SELECT user_id, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.8), 6) AS q80
       FROM events GROUP BY user_id""",
)
def group_quantile(spark, sf):
    events = table_reader(spark, sf)("events").select("user_id", "value")
    return rounded(panel.group_quantiles(events, ["user_id"], "value", {"q25": 0.25, "q80": 0.8}), 6, "q25", "q80")
