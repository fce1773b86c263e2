"""Relational reports over the orders star schema.

Each job reads whole tables; filters in the jobs are query predicates that
Catalyst pushes into the parquet scan, never row caps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.exact import sum_units_cents, sum_units_double, units
from tidewater.operators.joins import band_join, broadcast_if_small
from tidewater.operators.ranking import group_ranks
from tidewater.plans.catalog import job
from tidewater.session import scratch_path
from tidewater.sources.tables import Tables

# Fixed parameters of the reports.
SHIP_CUTOFF = "2000-09-02"  # pricing summary: lines shipped on or before this day
REVENUE_YEAR = 1997  # region revenue: orders placed in this year
PRICE_BANDS = [("budget", float("-inf"), 930.0), ("standard", 930.0, 970.0), ("premium", 970.0, float("inf"))]
TOP_PER_NATION = 3
LARGEST_ORDERS = 10
SINK_YEAR = 1999


# --------------------------------------------------------------------------
# pricing summary (flagship)
# --------------------------------------------------------------------------


def pricing_summary_df(lineitem: DataFrame) -> DataFrame:
    # money as exact integer units: cents, hundredths of the rates, and their
    # products (1e-4 and 1e-6 of a unit) -- long arithmetic in generated code
    price = units("l_extendedprice")
    disc = units("l_discount")
    disc_price = price * (F.lit(100) - disc)
    charge = disc_price * (F.lit(100) + units("l_tax"))
    n = F.count(F.lit(1))
    return (
        lineitem.filter(F.col("l_shipdate") <= F.lit(SHIP_CUTOFF).cast("timestamp_ntz"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_quantity").alias("sum_qty"),
            sum_units_cents(price, 2).alias("sum_base_price"),
            sum_units_cents(disc_price, 4).alias("sum_disc_price"),
            sum_units_cents(charge, 6).alias("sum_charge"),
            (F.sum("l_quantity") / n).alias("avg_qty"),
            (sum_units_cents(price, 2) / n).alias("avg_price"),
            (sum_units_double(disc, 2) / n).alias("avg_disc"),
            n.alias("count_order"),
        )
        .orderBy("l_returnflag", "l_linestatus")
    )


@job(
    "pricing_summary",
    f"""
    SELECT l_returnflag, l_linestatus,
           SUM(l_quantity) AS sum_qty,
           CAST(ROUND(SUM(CAST(l_extendedprice AS DECIMAL(18,2))), 2) AS DOUBLE) AS sum_base_price,
           CAST(ROUND(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(6,2)))), 2) AS DOUBLE) AS sum_disc_price,
           CAST(ROUND(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(6,2)))
                          * (1 + CAST(l_tax AS DECIMAL(6,2)))), 2) AS DOUBLE) AS sum_charge,
           SUM(l_quantity) / COUNT(*) AS avg_qty,
           CAST(ROUND(SUM(CAST(l_extendedprice AS DECIMAL(18,2))), 2) AS DOUBLE) / COUNT(*) AS avg_price,
           CAST(SUM(CAST(l_discount AS DECIMAL(6,2))) AS DOUBLE) / COUNT(*) AS avg_disc,
           COUNT(*) AS count_order
    FROM lineitem
    WHERE l_shipdate <= TIMESTAMP '{SHIP_CUTOFF}'
    GROUP BY l_returnflag, l_linestatus
    ORDER BY l_returnflag, l_linestatus
    """,
)
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pricing_summary_df(Tables(spark, sf_dir).lineitem)


# --------------------------------------------------------------------------
# scans and sinks
# --------------------------------------------------------------------------


@job(
    "scan_pruned",
    """
    SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
    WHERE l_quantity > 45 AND l_returnflag = 'R'
    """,
)
def scan_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Both predicates reach the scan as PushedFilters; ReadSchema holds only
    # the four columns named here.
    return (
        Tables(spark, sf_dir)
        .lineitem.filter((F.col("l_quantity") > 45) & (F.col("l_returnflag") == "R"))
        .select("l_orderkey", "l_partkey", "l_quantity")
    )


@job(
    "partitioned_sink",
    f"""
    SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate,
           CAST(year(l_shipdate) AS BIGINT) AS ship_year
    FROM lineitem WHERE year(l_shipdate) = {SINK_YEAR}
    """,
)
def partitioned_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write lineitem partitioned by ship year into the shared checkpoint
    folder, then read one year back: the filter becomes a PartitionFilter and
    only that folder is listed and read.

    The rows are rebalanced by year before the write, so a folder gets files
    of the advisory size and not one file a scan task; a year too large for
    one task is split by AQE."""
    path = scratch_path(spark, "lineitem_by_year")
    (
        Tables(spark, sf_dir)
        .lineitem.select(
            "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", F.year("l_shipdate").alias("ship_year")
        )
        .hint("rebalance", "ship_year")
        .write.mode("overwrite")
        .partitionBy("ship_year")
        .parquet(path)
    )
    back = spark.read.parquet(path).filter(F.col("ship_year") == SINK_YEAR)
    return back.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", F.col("ship_year").cast("bigint").alias("ship_year")
    )


@job(
    "table_contract",
    """
    SELECT * FROM (
      SELECT 'customer' AS tbl, 'rows' AS check_name, COUNT(*) AS n FROM customer
      UNION ALL SELECT 'customer', 'null_key', COUNT(*) - COUNT(c_custkey) FROM customer
      UNION ALL SELECT 'customer', 'dup_key', COUNT(c_custkey) - COUNT(DISTINCT c_custkey) FROM customer
      UNION ALL SELECT 'orders', 'rows', COUNT(*) FROM orders
      UNION ALL SELECT 'orders', 'null_key', COUNT(*) - COUNT(o_orderkey) FROM orders
      UNION ALL SELECT 'orders', 'dup_key', COUNT(o_orderkey) - COUNT(DISTINCT o_orderkey) FROM orders
      UNION ALL SELECT 'orders', 'orphan_customer',
                (SELECT COUNT(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey))
      UNION ALL SELECT 'lineitem', 'rows', COUNT(*) FROM lineitem
      UNION ALL SELECT 'lineitem', 'null_key', COUNT(*) - COUNT(l_orderkey) FROM lineitem
      UNION ALL SELECT 'lineitem', 'orphan_order',
                (SELECT COUNT(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey))
      UNION ALL SELECT 'lineitem', 'orphan_part',
                (SELECT COUNT(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey))
      UNION ALL SELECT 'part', 'rows', COUNT(*) FROM part
      UNION ALL SELECT 'part', 'dup_key', COUNT(p_partkey) - COUNT(DISTINCT p_partkey) FROM part
      UNION ALL SELECT 'supplier', 'rows', COUNT(*) FROM supplier
      UNION ALL SELECT 'supplier', 'dup_key', COUNT(s_suppkey) - COUNT(DISTINCT s_suppkey) FROM supplier
      UNION ALL SELECT 'labels', 'orphan_document',
                (SELECT COUNT(*) FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id))
      UNION ALL SELECT 'documents', 'dup_key', COUNT(doc_id) - COUNT(DISTINCT doc_id) FROM documents
    )
    """,
)
def table_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data-contract report: row counts, null and duplicate keys, orphans."""
    t = Tables(spark, sf_dir)

    def keyed(df: DataFrame, name: str, key: str, dup: bool = True) -> list[DataFrame]:
        aggs = [
            F.count(F.lit(1)).alias("rows"),
            (F.count(F.lit(1)) - F.count(key)).alias("null_key"),
        ]
        if dup:
            aggs.append((F.count(key) - F.countDistinct(key)).alias("dup_key"))
        row = df.agg(*aggs)
        cols = [c for c in row.columns]
        stacked = row.select(
            F.explode(F.array(*[F.struct(F.lit(c).alias("check_name"), F.col(c).alias("n")) for c in cols])).alias("s")
        )
        return [stacked.select(F.lit(name).alias("tbl"), "s.check_name", "s.n")]

    def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, name: str, check: str) -> DataFrame:
        missing = child.select(fk).join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")
        return missing.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("tbl"), F.lit(check).alias("check_name"), "n"
        )

    parts = []
    parts += keyed(t.customer, "customer", "c_custkey")
    parts += keyed(t.orders, "orders", "o_orderkey")
    parts.append(orphans(t.orders, "o_custkey", t.customer, "c_custkey", "orders", "orphan_customer"))
    parts += keyed(t.lineitem, "lineitem", "l_orderkey", dup=False)
    parts.append(orphans(t.lineitem, "l_orderkey", t.orders, "o_orderkey", "lineitem", "orphan_order"))
    parts.append(orphans(t.lineitem, "l_partkey", t.part, "p_partkey", "lineitem", "orphan_part"))
    parts.append(
        t.part.agg((F.count("p_partkey") - F.countDistinct("p_partkey")).alias("dup_key"), F.count(F.lit(1)).alias("rows"))
        .select(F.explode(F.array(
            F.struct(F.lit("rows").alias("check_name"), F.col("rows").alias("n")),
            F.struct(F.lit("dup_key").alias("check_name"), F.col("dup_key").alias("n")),
        )).alias("s"))
        .select(F.lit("part").alias("tbl"), "s.check_name", "s.n")
    )
    parts.append(
        t.supplier.agg((F.count("s_suppkey") - F.countDistinct("s_suppkey")).alias("dup_key"), F.count(F.lit(1)).alias("rows"))
        .select(F.explode(F.array(
            F.struct(F.lit("rows").alias("check_name"), F.col("rows").alias("n")),
            F.struct(F.lit("dup_key").alias("check_name"), F.col("dup_key").alias("n")),
        )).alias("s"))
        .select(F.lit("supplier").alias("tbl"), "s.check_name", "s.n")
    )
    parts.append(orphans(t.labels, "doc_id", t.documents, "doc_id", "labels", "orphan_document"))
    parts.append(
        t.documents.agg((F.count("doc_id") - F.countDistinct("doc_id")).alias("n")).select(
            F.lit("documents").alias("tbl"), F.lit("dup_key").alias("check_name"), "n"
        )
    )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --------------------------------------------------------------------------
# joins
# --------------------------------------------------------------------------


@job(
    "region_revenue",
    f"""
    SELECT n.n_name, r.r_name,
           CAST(ROUND(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(6,2)))), 2) AS DOUBLE) AS revenue,
           COUNT(*) AS n_lines
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey AND c.c_nationkey = s.s_nationkey
    JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    WHERE o.o_orderdate >= TIMESTAMP '{REVENUE_YEAR}-01-01' AND o.o_orderdate < TIMESTAMP '{REVENUE_YEAR + 1}-01-01'
    GROUP BY n.n_name, r.r_name
    """,
)
def region_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue of lines whose customer and supplier share a nation, per nation.

    One year's orders meet their customers first, so the large table of lines
    is shuffled once, by order; suppliers are broadcast after a check of their
    size, nation and region (25 and 5 rows by definition) without one.  AQE
    switches any side it measures as small to broadcast and splits skewed
    partitions (one hot customer) at run time.
    """
    t = Tables(spark, sf_dir)
    orders = t.orders.filter(
        (F.col("o_orderdate") >= F.lit(f"{REVENUE_YEAR}-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit(f"{REVENUE_YEAR + 1}-01-01").cast("timestamp_ntz"))
    ).select("o_orderkey", "o_custkey")
    lines = t.lineitem.select("l_orderkey", "l_suppkey", "l_extendedprice", "l_discount")
    cust = t.customer.select(F.col("c_custkey"), F.col("c_nationkey"))
    supp = broadcast_if_small(t.supplier.select("s_suppkey", "s_nationkey"))
    nation = F.broadcast(t.nation.select("n_nationkey", "n_name", "n_regionkey"))
    region = F.broadcast(t.region.select("r_regionkey", "r_name"))
    joined = (
        lines.join(
            orders.join(cust, F.col("o_custkey") == cust.c_custkey).select("o_orderkey", "c_nationkey"),
            F.col("l_orderkey") == F.col("o_orderkey"),
        )
        .join(supp, (F.col("l_suppkey") == supp.s_suppkey) & (F.col("c_nationkey") == supp.s_nationkey))
        .join(nation, F.col("s_nationkey") == nation.n_nationkey)
        .join(region, F.col("n_regionkey") == region.r_regionkey)
    )
    return joined.groupBy("n_name", "r_name").agg(
        sum_units_cents(units("l_extendedprice") * (F.lit(100) - units("l_discount")), 4).alias("revenue"),
        F.count(F.lit(1)).alias("n_lines"),
    )


@job(
    "orders_with_returns",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
    WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')
    """,
)
def orders_with_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    returned = t.lineitem.filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").join(returned, "o_orderkey", "left_semi")


@job(
    "orders_without_lines",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o
    WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
    """,
)
def orders_without_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    keys = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus").join(keys, "o_orderkey", "left_anti")


_BANDS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS band, CAST('{lo}' AS DOUBLE) AS lo, CAST('{hi}' AS DOUBLE) AS hi" for name, lo, hi in PRICE_BANDS
)


@job(
    "price_bands",
    f"""
    SELECT b.band, COUNT(*) AS n_parts,
           CAST(ROUND(SUM(CAST(p.p_retailprice AS DECIMAL(18,2))), 2) AS DOUBLE) / COUNT(*) AS avg_price,
           MIN(p.p_retailprice) AS min_price, MAX(p.p_retailprice) AS max_price
    FROM part p JOIN ({_BANDS_SQL}) b ON p.p_retailprice >= b.lo AND p.p_retailprice < b.hi
    GROUP BY b.band
    """,
)
def price_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = spark.createDataFrame(PRICE_BANDS, "band string, lo double, hi double")
    part = Tables(spark, sf_dir).part.select("p_partkey", "p_retailprice")
    return (
        band_join(part, bands, F.col("p_retailprice"))
        .groupBy("band")
        .agg(
            F.count(F.lit(1)).alias("n_parts"),
            (sum_units_cents(units("p_retailprice"), 2) / F.count(F.lit(1))).alias("avg_price"),
            F.min("p_retailprice").alias("min_price"),
            F.max("p_retailprice").alias("max_price"),
        )
    )


# --------------------------------------------------------------------------
# grouping: rollup / cube / grouping sets / distinct / pivot / percentiles
# --------------------------------------------------------------------------


@job(
    "customers_rollup",
    """
    SELECT r.r_name, n.n_name, COUNT(*) AS n_customers,
           CAST(ROUND(SUM(CAST(c.c_acctbal AS DECIMAL(18,2))), 2) AS DOUBLE) AS total_acctbal,
           CAST(GROUPING(r.r_name, n.n_name) AS BIGINT) AS grouping_level
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    GROUP BY ROLLUP (r.r_name, n.n_name)
    """,
)
def customers_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    nation = F.broadcast(t.nation.select("n_nationkey", "n_name", "n_regionkey"))
    region = F.broadcast(t.region.select("r_regionkey", "r_name"))
    c = (
        t.customer.select("c_nationkey", "c_acctbal")
        .join(nation, F.col("c_nationkey") == nation.n_nationkey)
        .join(region, F.col("n_regionkey") == region.r_regionkey)
    )
    return c.rollup("r_name", "n_name").agg(
        F.count(F.lit(1)).alias("n_customers"),
        sum_units_cents(units("c_acctbal"), 2).alias("total_acctbal"),
        F.grouping_id("r_name", "n_name").cast("bigint").alias("grouping_level"),
    )


@job(
    "flags_cube",
    """
    SELECT l_returnflag, l_linestatus, COUNT(*) AS n_lines, SUM(l_quantity) AS sum_qty,
           CAST(GROUPING(l_returnflag, l_linestatus) AS BIGINT) AS grouping_level
    FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)
    """,
)
def flags_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        Tables(spark, sf_dir)
        .lineitem.cube("l_returnflag", "l_linestatus")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum("l_quantity").alias("sum_qty"),
            F.grouping_id("l_returnflag", "l_linestatus").cast("bigint").alias("grouping_level"),
        )
    )


@job(
    "orders_grouping_sets",
    """
    SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n_orders,
           CAST(ROUND(SUM(CAST(o_totalprice AS DECIMAL(18,2))), 2) AS DOUBLE) AS total_price
    FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())
    """,
)
def orders_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    sets = Tables(spark, sf_dir).orders.groupingSets([[status], [priority], []], status, priority)
    total = F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")), 2).cast("double")
    return sets.agg(F.count(F.lit(1)).alias("n_orders"), total.alias("total_price"))


@job(
    "users_per_event",
    """
    SELECT event_type, COUNT(DISTINCT user_id) AS n_users, COUNT(*) AS n_events
    FROM events GROUP BY event_type
    """,
)
def users_per_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Spark plans the distinct count as an aggregate on (event_type, user_id)
    # first, so a hot event type is spread over many tasks before the final
    # per-type count.
    return (
        Tables(spark, sf_dir)
        .events.groupBy("event_type")
        .agg(F.countDistinct("user_id").alias("n_users"), F.count(F.lit(1)).alias("n_events"))
    )


# Five standard errors of approx_count_distinct at 0.01 and of a sketch of 2^12 registers.
APPROX_BOUND, SKETCH_BOUND = 0.05, 0.08


@job(
    "users_approx",
    """
    SELECT event_type, COUNT(DISTINCT user_id) AS exact_users, TRUE AS approx_within, TRUE AS sketch_within
    FROM events GROUP BY event_type
    """,
)
def users_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate distinct users per event type: HyperLogLog++ through
    ``approx_count_distinct`` next to a mergeable ``hll_sketch_agg`` sketch,
    which can be stored and unioned across days.  The exact count stands
    beside them, with whether each estimate is within its bound of it."""
    counts = (
        Tables(spark, sf_dir)
        .events.groupBy("event_type")
        .agg(
            F.approx_count_distinct("user_id", 0.01).alias("approx_users"),
            F.hll_sketch_estimate(F.hll_sketch_agg("user_id", 12)).alias("sketch_users"),
            F.countDistinct("user_id").alias("exact_users"),
        )
    )

    def within(estimate: str, bound: float) -> F.Column:
        return F.abs(F.col(estimate) - F.col("exact_users")) <= F.col("exact_users") * F.lit(bound)

    return counts.select(
        "event_type", "exact_users",
        within("approx_users", APPROX_BOUND).alias("approx_within"),
        within("sketch_users", SKETCH_BOUND).alias("sketch_within"),
    )


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@job(
    "event_pivot",
    """
    SELECT user_id,
           COUNT(*) FILTER (WHERE event_type = 'click') AS click,
           COUNT(*) FILTER (WHERE event_type = 'error') AS error,
           COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchase,
           COUNT(*) FILTER (WHERE event_type = 'signup') AS signup,
           COUNT(*) FILTER (WHERE event_type = 'view') AS "view",
           COUNT(*) FILTER (WHERE event_type IS NULL
                            OR event_type NOT IN ('click', 'error', 'purchase', 'signup', 'view')) AS other
    FROM events GROUP BY user_id
    """,
)
def event_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_pivot_df(Tables(spark, sf_dir).events)


def event_pivot_df(events: DataFrame) -> DataFrame:
    # Listing the pivot values skips the extra job that would find them; any
    # other type, and null, counts as "other".
    kind = F.when(F.col("event_type").isin(EVENT_TYPES), F.col("event_type")).otherwise("other")
    values = [*EVENT_TYPES, "other"]
    p = events.select("user_id", kind.alias("kind")).groupBy("user_id").pivot("kind", values).agg(F.count(F.lit(1)))
    return p.select("user_id", *[F.coalesce(F.col(v), F.lit(0)).cast("bigint").alias(v) for v in values])


@job(
    "value_percentiles",
    """
    SELECT event_type,
           quantile_cont(value, 0.5) AS p50,
           quantile_cont(value, 0.95) AS p95,
           COUNT(*) AS n
    FROM events GROUP BY event_type
    """,
)
def value_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.operators.quantiles import exact_percentiles

    ev = Tables(spark, sf_dir).events.select("event_type", "value")
    return exact_percentiles(ev, ["event_type"], "value", {"p50": 0.5, "p95": 0.95}, count_col="n")


# --------------------------------------------------------------------------
# ranking and windows
# --------------------------------------------------------------------------


@job(
    "top_customers_by_nation",
    f"""
    SELECT c_nationkey, c_custkey, c_name, c_acctbal, rn FROM (
      SELECT c_nationkey, c_custkey, c_name, c_acctbal,
             row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn
      FROM customer) WHERE rn <= {TOP_PER_NATION}
    """,
)
def top_customers_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-k per group.  ``row_number() <= k`` over a window plans as a
    WindowGroupLimit that keeps k rows per group on the map side before the
    shuffle, so a hot nation ships at most k rows per input partition."""
    from pyspark.sql.window import Window

    w = Window.partitionBy("c_nationkey").orderBy(F.col("c_acctbal").desc(), F.col("c_custkey"))
    c = Tables(spark, sf_dir).customer.select("c_nationkey", "c_custkey", "c_name", "c_acctbal")
    return (
        c.withColumn("rn", F.row_number().over(w))
        .filter(F.col("rn") <= TOP_PER_NATION)
        .withColumn("rn", F.col("rn").cast("bigint"))
    )


@job(
    "supplier_ranks",
    """
    SELECT s_suppkey, s_nationkey, s_acctbal,
           rank() OVER w AS rnk,
           dense_rank() OVER w AS drnk,
           row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS rn,
           ntile(4) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS quartile,
           percent_rank() OVER w AS pct_rank,
           cume_dist() OVER w AS cume
    FROM supplier
    WINDOW w AS (PARTITION BY s_nationkey ORDER BY s_acctbal)
    """,
)
def supplier_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rank, dense_rank, row_number, ntile, percent_rank and cume_dist per
    nation, computed from a global sequence number instead of a window per
    nation, so one nation holding most suppliers is still split over tasks."""
    s = Tables(spark, sf_dir).supplier.select("s_suppkey", "s_nationkey", "s_acctbal")
    return group_ranks(s, ["s_nationkey"], "s_acctbal", "s_suppkey", ntile=4)


@job(
    "largest_orders",
    f"""
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT {LARGEST_ORDERS}
    """,
)
def largest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sort + limit -> TakeOrderedAndProject: a k-row heap per partition.
    return (
        Tables(spark, sf_dir)
        .orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
        .orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey"))
        .limit(LARGEST_ORDERS)
    )


# --------------------------------------------------------------------------
# set operations
# --------------------------------------------------------------------------


@job(
    "nation_intersect",
    """
    SELECT c_nationkey AS nationkey FROM customer
    INTERSECT SELECT s_nationkey FROM supplier
    """,
)
def nation_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return t.customer.select(F.col("c_nationkey").alias("nationkey")).intersect(
        t.supplier.select(F.col("s_nationkey").alias("nationkey"))
    )


@job(
    "customers_except",
    """
    SELECT c_custkey FROM customer
    EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
    """,
)
def customers_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").subtract(urgent)


@job(
    "parties_union",
    """
    SELECT 'customer' AS kind, c_name AS name, c_nationkey AS nationkey FROM customer
    UNION SELECT 'supplier', s_name, s_nationkey FROM supplier
    """,
)
def parties_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    c = t.customer.select(F.lit("customer").alias("kind"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"))
    s = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"))
    return c.unionByName(s).distinct()


# --------------------------------------------------------------------------
# scalar functions: strings, dates, JSON
# --------------------------------------------------------------------------


@job(
    "part_text",
    """
    SELECT p_partkey,
           upper(p_name) AS name_upper,
           regexp_replace(p_brand, '[^0-9]', '', 'g') AS brand_no,
           split_part(p_name, ' ', 1) AS first_word,
           CAST(length(p_name) AS BIGINT) AS name_len,
           concat(p_type, '/', CAST(p_size AS VARCHAR)) AS type_size,
           lpad(CAST(p_size AS VARCHAR), 3, '0') AS size_padded,
           starts_with(p_type, 'E') AS type_e,
           replace(p_name, ' ', '_') AS name_key
    FROM part
    """,
)
def part_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Tables(spark, sf_dir).part
    return p.select(
        "p_partkey",
        F.upper("p_name").alias("name_upper"),
        F.regexp_replace("p_brand", "[^0-9]", "").alias("brand_no"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("first_word"),
        F.length("p_name").cast("bigint").alias("name_len"),
        F.concat("p_type", F.lit("/"), F.col("p_size").cast("string")).alias("type_size"),
        F.lpad(F.col("p_size").cast("string"), 3, "0").alias("size_padded"),
        F.startswith(F.col("p_type"), F.lit("E")).alias("type_e"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("_")).alias("name_key"),
    )


@job(
    "order_calendar",
    """
    SELECT o_orderkey,
           CAST(year(o_orderdate) AS BIGINT) AS yr,
           CAST(quarter(o_orderdate) AS BIGINT) AS qtr,
           CAST(month(o_orderdate) AS BIGINT) AS mon,
           CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month_start,
           CAST(isodow(o_orderdate) AS BIGINT) AS iso_dow,
           CAST(date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') AS BIGINT) AS days_to_2002,
           CAST(o_orderdate + INTERVAL 30 DAY AS TIMESTAMP) AS due_date,
           strftime(o_orderdate, '%Y-%m') AS ym
    FROM orders
    """,
)
def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    d = F.col("o_orderdate")
    return o.select(
        "o_orderkey",
        F.year(d).cast("bigint").alias("yr"),
        F.quarter(d).cast("bigint").alias("qtr"),
        F.month(d).cast("bigint").alias("mon"),
        F.date_trunc("month", d).cast("timestamp_ntz").alias("month_start"),
        # Spark's dayofweek is 1 = Sunday; ISO is 1 = Monday.
        (F.pmod(F.dayofweek(d) + 5, F.lit(7)) + 1).cast("bigint").alias("iso_dow"),
        F.datediff(F.lit("2002-01-01").cast("date"), d.cast("date")).cast("bigint").alias("days_to_2002"),
        (d + F.expr("INTERVAL 30 DAYS")).cast("timestamp_ntz").alias("due_date"),
        F.date_format(d, "yyyy-MM").alias("ym"),
    )


@job(
    "event_json",
    """
    SELECT event_type,
           CAST(SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
           MAX(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS max_k,
           COUNT(*) FILTER (WHERE json_extract_string(props, '$.k') IS NULL) AS missing_k
    FROM events GROUP BY event_type
    """,
)
def event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return (
        Tables(spark, sf_dir)
        .events.withColumn("k", k)
        .groupBy("event_type")
        .agg(
            F.sum("k").cast("bigint").alias("sum_k"),
            F.max("k").alias("max_k"),
            F.count(F.when(F.col("k").isNull(), 1)).alias("missing_k"),
        )
    )

