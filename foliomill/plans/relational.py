"""The plain relational surface that the survey's cross-check asks for, on the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.sequences import forward_fill, row_numbers
from ..runtime import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _add(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return put


@_add("r_aggregate", "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS qty, avg(l_discount) AS disc, min(l_tax) AS least_tax, max(l_tax) AS most_tax, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def _(s, d):
    li = table(s, d, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("qty"), F.avg("l_discount").alias("disc"), F.min("l_tax").alias("least_tax"), F.max("l_tax").alias("most_tax"), F.count("*").alias("n"))


@_add("r_join_chain", "SELECT n_name, count(*) AS orders, sum(o_totalprice) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def _(s, d):
    # Totals by customer first: the join then carries one row a customer, however many orders a hot one has.
    per = table(s, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("k"), F.sum("o_totalprice").alias("t"))
    j = per.join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.sum("k").alias("k"), F.sum("t").alias("t"))
    return j.join(table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.sum("k").alias("orders"), F.sum("t").alias("total"))


@_add("r_semi_anti", "SELECT c_mktsegment, count(*) FILTER (EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)) AS with_orders, count(*) FILTER (NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)) AS without FROM customer GROUP BY ALL")
def _(s, d):
    c, o = table(s, d, "customer"), table(s, d, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    a = c.join(o, "c_custkey", "left_semi").select("c_mktsegment", F.lit(1).alias("w"))
    b = c.join(o, "c_custkey", "left_anti").select("c_mktsegment", F.lit(0).alias("w"))
    return a.unionAll(b).groupBy("c_mktsegment").agg(F.sum("w").alias("with_orders"), F.sum(1 - F.col("w")).alias("without"))


@_add("r_rollup", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def _(s, d):
    return table(s, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@_add("r_cube", "SELECT lang, source, count(*) AS n, grouping_id(lang, source) AS g FROM documents GROUP BY CUBE (lang, source)")
def _(s, d):
    return table(s, d, "documents").cube("lang", "source").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))


@_add("r_pivot", "SELECT event_type, count(*) FILTER (extract('dow' FROM ts) = 1) AS monday, count(*) FILTER (extract('dow' FROM ts) = 2) AS tuesday FROM events GROUP BY ALL")
def _(s, d):
    e = table(s, d, "events").withColumn("day", F.dayofweek("ts"))
    return e.groupBy("event_type").pivot("day", [2, 3]).count().select("event_type", F.coalesce("2", F.lit(0)).alias("monday"), F.coalesce("3", F.lit(0)).alias("tuesday"))


@_add("r_set_operations", "(SELECT DISTINCT l_partkey AS k, 'both' AS side FROM lineitem WHERE l_returnflag = 'A' INTERSECT SELECT l_partkey, 'both' FROM lineitem WHERE l_returnflag = 'R') UNION ALL (SELECT DISTINCT l_partkey, 'only_a' FROM lineitem WHERE l_returnflag = 'A' EXCEPT SELECT l_partkey, 'only_a' FROM lineitem WHERE l_returnflag = 'R')")
def _(s, d):
    li = table(s, d, "lineitem")
    a, r = (li.where(F.col("l_returnflag") == x).select(F.col("l_partkey").alias("k")) for x in "AR")
    return a.intersect(r).withColumn("side", F.lit("both")).unionAll(a.subtract(r).withColumn("side", F.lit("only_a")))


@_add("r_top_k", "SELECT l_suppkey, l_orderkey, l_linenumber, rank FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank FROM lineitem) WHERE rank <= 3")
def _(s, d):
    w = W.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
    return table(s, d, "lineitem").withColumn("rank", F.row_number().over(w)).where("rank <= 3").select("l_suppkey", "l_orderkey", "l_linenumber", "rank")


@_add("r_running_number", "SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events")
def _(s, d):
    return row_numbers(table(s, d, "events").select("event_id", "event_type"), ["event_type"], F.col("event_id"), "n", block=4096).select("event_id", "n")


@_add("r_asof", "SELECT e.event_id, max(b.ts) AS last_error FROM events e LEFT JOIN events b ON b.user_id = e.user_id AND b.event_type = 'error' AND b.ts <= e.ts GROUP BY e.event_id")
def _(s, d):
    """As-of join of each event with the last error of its user: a forward fill in blocks of an hour of time."""
    e = table(s, d, "events").select("event_id", "user_id", "ts", "event_type")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return forward_fill(e, ["user_id"], micros, F.when(F.col("event_type") == "error", F.col("ts")), "last_error", block=86_400_000_000 * 7).select("event_id", "last_error")


@_add("r_interval_join", "SELECT a.event_id AS view_id, count(b.event_id) AS clicks FROM events a LEFT JOIN events b ON b.user_id = a.user_id AND b.event_type = 'click' AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 1 HOUR WHERE a.event_type = 'view' GROUP BY ALL")
def _(s, d):
    """Interval join on user and hour: a click can lie in the view's hour or the next, so each view meets two buckets."""
    e = table(s, d, "events").select("event_id", "user_id", "ts", "event_type").withColumn("hour", F.date_trunc("hour", F.col("ts").cast("timestamp")))
    v = e.where("event_type = 'view'").select("event_id", "user_id", "ts", F.explode(F.array("hour", F.col("hour") + F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    c = e.where("event_type = 'click'").select("user_id", F.col("ts").alias("c_ts"), "hour")
    hit = F.col("c_ts").isNotNull() & (F.col("c_ts") > F.col("ts")) & (F.col("c_ts") <= F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    return v.join(c, ["user_id", "hour"], "left").groupBy(F.col("event_id").alias("view_id")).agg(F.count_if(hit).alias("clicks"))


@_add("r_sessions", "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w > INTERVAL 30 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), k AS (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts) k FROM g) SELECT user_id, min(ts) AS started, count(*) AS events FROM k GROUP BY user_id, k")
def _(s, d):
    e = table(s, d, "events").withColumn("t", F.col("ts").cast("timestamp"))
    # session_window ends a session at exactly the gap; one microsecond more keeps an event at the gap within it.
    got = e.groupBy("user_id", F.session_window("t", "1800 seconds 1 microsecond").alias("w")).agg(F.count("*").alias("events"))
    return got.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("started"), "events")


@_add("r_windows", "SELECT user_id, time_bucket(INTERVAL 1 HOUR, ts) AS hour, count(*) AS n, sum(value) AS total FROM events GROUP BY ALL")
def _(s, d):
    e = table(s, d, "events").groupBy("user_id", F.window(F.col("ts").cast("timestamp"), "1 hour").alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return e.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("hour"), "n", "total")


@_add("r_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events")
def _(s, d):
    return table(s, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@_add("r_dates", "SELECT o_orderkey, date_diff('day', o_orderdate, TIMESTAMP '1998-12-31') AS age, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def _(s, d):
    return table(s, d, "orders").select("o_orderkey", F.datediff(F.lit("1998-12-31"), "o_orderdate").alias("age"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))


@_add("r_approximate")
def _(s, d):
    li = table(s, d, "lineitem")
    return li.groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey").alias("parts"), F.percentile_approx("l_extendedprice", [0.25, 0.5, 0.75]).alias("quartiles"))


@_add("r_vectors", "SELECT label, count(*) AS n, avg(list_dot_product(embedding, embedding)) AS mean_square FROM embeddings GROUP BY ALL")
def _(s, d):
    sq = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    return table(s, d, "embeddings").groupBy("label").agg(F.count("*").alias("n"), F.avg(sq).alias("mean_square"))
