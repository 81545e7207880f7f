"""Selections, lookups, upserts, counters and ids over the relational tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import filters, ids, rankindex, upserts
from corpusloom.sources.state import store
from corpusloom.sources.tables import read_table


def select_where(spark, folder):
    customers = read_table(spark, folder, "customer")
    return filters.select_where(customers, {"c_mktsegment": "BUILDING", "c_nationkey": 7}, ["c_custkey", "c_name", "c_acctbal"])


def select_all(spark, folder):
    return filters.select_where(read_table(spark, folder, "nation"))


def count_where(spark, folder):
    orders = read_table(spark, folder, "orders")
    return filters.count_where(orders, "o_totalprice", {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"})


def in_set(spark, folder):
    """Orders of the customers of one segment."""
    wanted = read_table(spark, folder, "customer").filter(F.col("c_mktsegment") == "MACHINERY").select("c_custkey")
    return filters.in_set(read_table(spark, folder, "orders", ["o_custkey", "o_orderkey"]), "o_custkey", wanted)


def key_lookup(spark, folder):
    return filters.lookup(read_table(spark, folder, "part"), "p_partkey", 17, {"p_partkey": "long", "p_size": "int"})


def typed_scan(spark, folder):
    """The last order of each customer; the columns with a hint are numbers, all others text."""
    orders = read_table(spark, folder, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])
    return filters.typed_scan(orders, "o_orderkey", {"o_orderkey": "long", "o_custkey": "INT"}, "o_custkey")


def typed_scan_first(spark, folder):
    """The first 25 parts by key."""
    parts = read_table(spark, folder, "part", ["p_partkey", "p_name", "p_size"])
    return filters.typed_scan(parts, "p_partkey", {"p_partkey": "int"}, limit=25)


def category_search(spark, folder):
    """Parts whose type holds one of several words and whose name starts with another."""
    parts = read_table(spark, folder, "part", ["p_partkey", "p_name", "p_type"])
    return parts.filter(filters.any_contains("p_type", ["ECON", "LARGE"]) & F.col("p_name").startswith("blue"))


def _events(spark, folder, kind):
    events = read_table(spark, folder, "events", ["event_id", "user_id", "event_type", "value"])
    return events.filter(F.col("event_type") == kind)


def _viewers(spark, folder):
    """One row per user with a view worth more than 110: the value of the last one."""
    last = filters.last_row(_events(spark, folder, "view").filter("value > 110"), "user_id", "event_id")
    return last.select("user_id", "value", F.col("event_id").cast("string").alias("seen"))


def _buyers(spark, folder):
    """Purchases worth more than 90."""
    return _events(spark, folder, "purchase").filter("value > 90").select("user_id", "value", F.col("event_id").alias("place"))


def insert_absent(spark, folder):
    return upserts.insert_absent(_viewers(spark, folder), _buyers(spark, folder), "user_id", "place")


def insert_status(spark, folder):
    return upserts.insert_status(_viewers(spark, folder), _buyers(spark, folder), "user_id")


def merge_columns(spark, folder):
    return upserts.merge_columns(store(_viewers(spark, folder), "user_id"), _buyers(spark, folder), "user_id", "place")


def union_by_key(spark, folder):
    """Users of two kinds of events; those of both come once."""
    users = [_events(spark, folder, k).select("user_id") for k in ("view", "purchase")]
    return upserts.union_by_key(*users, "user_id")


def upsert_count(spark, folder):
    """Users with ids, the last kind of event and the number of events: viewers first, then everything that happened."""
    empty = spark.createDataFrame([], "user_id bigint, uid bigint, kind string, seen bigint")
    events = read_table(spark, folder, "events", ["event_id", "user_id", "event_type"]).withColumnRenamed("event_type", "kind")
    views = events.filter(F.col("kind") == "view")
    table = store(upserts.upsert_count(empty, views, "user_id", "event_id", ["kind"], "seen", "uid"), "user_id")
    return upserts.upsert_count(table, events, "user_id", "event_id", ["kind"], "seen", "uid")


def delete_keys(spark, folder):
    """Customers without an urgent finished order."""
    orders = read_table(spark, folder, "orders", ["o_custkey", "o_orderstatus", "o_orderpriority"]).withColumnRenamed("o_custkey", "c_custkey")
    orders = orders.filter(filters.all_equal({"o_orderstatus": "F", "o_orderpriority": "1-URGENT"}))
    return upserts.delete_keys(read_table(spark, folder, "customer", ["c_custkey", "c_name"]), orders, "c_custkey")


def delete_prefix(spark, folder):
    return upserts.delete_prefix(read_table(spark, folder, "part", ["p_partkey", "p_name"]), "p_name", "red")


def update_where(spark, folder):
    parts = read_table(spark, folder, "part", ["p_partkey", "p_brand", "p_type", "p_size"])
    small = upserts.update_where(parts, {"p_size": 0, "p_brand": "none"}, {"p_type": "SMALL", "p_brand": "Brand#4"})
    return upserts.update_where(small, {"p_size": -1}, filters.any_contains("p_type", ["PROMO", "STANDARD"]))


def counter_add(spark, folder):
    """Counters per kind of event: those of even users, increased by those of odd ones."""
    events = read_table(spark, folder, "events", ["user_id", "event_type"])
    counted = events.groupBy((F.col("user_id") % 2).alias("part"), F.col("event_type").alias("key")).agg(F.count("*").alias("n"))
    old = counted.filter("part = 0").select("key", F.col("n").alias("value"))
    return upserts.add_counts(old, counted.filter("part = 1"), "key", "value")


def assigned_ids(spark, folder):
    """Ids of viewers, then of buyers that had none."""
    return upserts.assign_ids(_numbered(spark, folder), _buyers(spark, folder).select("user_id"), "user_id", "uid")


def replaced_ids(spark, folder):
    """Ids of viewers, with new ones for all buyers."""
    return upserts.assign_ids(_numbered(spark, folder), _buyers(spark, folder).select("user_id"), "user_id", "uid", replace=True)


def previous_ids(spark, folder):
    return upserts.previous_ids(_numbered(spark, folder), _buyers(spark, folder), "user_id", "uid")


def _numbered(spark, folder):
    return ids.dense_ids(_viewers(spark, folder).select("user_id"), "user_id", "uid")


def order_page(spark, folder):
    """Page 3 of 500 finished orders by key, from a rank index of them."""
    orders = read_table(spark, folder, "orders", ["o_orderkey", "o_orderstatus"]).filter(F.col("o_orderstatus") == "F")
    return rankindex.build(orders, "o_orderkey").page(3, 500)


def order_page_after(spark, folder):
    """The 500 finished orders after a key, from a rank index of them."""
    orders = read_table(spark, folder, "orders", ["o_orderkey", "o_orderstatus"]).filter(F.col("o_orderstatus") == "F")
    return rankindex.build(orders, "o_orderkey").after(777, 500)


VIEWERS = """viewers AS (SELECT user_id, arg_max(value, event_id) AS value, CAST(max(event_id) AS VARCHAR) AS seen
    FROM events WHERE event_type = 'view' AND value > 110 GROUP BY user_id)"""
BUYERS = "buyers AS (SELECT user_id, value, event_id AS place FROM events WHERE event_type = 'purchase' AND value > 90)"
ORDER = "substr(md5(CAST(user_id AS VARCHAR)), 1, 3), user_id"
NUMBERED = f"numbered AS (SELECT user_id, row_number() OVER (ORDER BY {ORDER}) AS uid FROM viewers)"

QUERIES = {
    "select_where": (select_where, "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 7"),
    "select_all": (select_all, "SELECT * FROM nation"),
    "count_where": (count_where, """SELECT count(o_totalprice) AS "count" FROM orders
        WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"""),
    "in_set": (in_set, """SELECT o_custkey, o_orderkey FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')"""),
    "key_lookup": (key_lookup, """SELECT p_partkey, p_name, p_brand, p_type, p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice
        FROM part WHERE p_partkey = 17"""),
    "typed_scan": (typed_scan, """SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus, o_orderpriority,
        CAST(o_custkey AS VARCHAR) AS row_key FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1"""),
    "typed_scan_first": (typed_scan_first, """SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name,
        CAST(p_size AS VARCHAR) AS p_size, CAST(p_partkey AS VARCHAR) AS row_key FROM part ORDER BY p_partkey LIMIT 25"""),
    "category_search": (category_search, """SELECT p_partkey, p_name, p_type FROM part
        WHERE (p_type LIKE '%ECON%' OR p_type LIKE '%LARGE%') AND p_name LIKE 'blue%'"""),
    "insert_absent": (insert_absent, f"""WITH {VIEWERS}, {BUYERS} SELECT user_id, value, seen FROM viewers UNION ALL
        SELECT user_id, arg_min(value, place), NULL FROM buyers WHERE user_id NOT IN (SELECT user_id FROM viewers) GROUP BY user_id"""),
    "insert_status": (insert_status, f"""WITH {VIEWERS}, {BUYERS} SELECT DISTINCT user_id,
        CASE WHEN user_id IN (SELECT user_id FROM viewers) THEN 1 ELSE 0 END AS existed FROM buyers"""),
    "merge_columns": (merge_columns, f"""WITH {VIEWERS}, {BUYERS}, fresh AS (
        SELECT user_id, arg_max(value, place) AS value FROM buyers GROUP BY user_id)
        SELECT user_id, coalesce(f.value, v.value) AS value, seen FROM viewers v FULL JOIN fresh f USING (user_id)"""),
    "union_by_key": (union_by_key, "SELECT DISTINCT user_id FROM events WHERE event_type IN ('view', 'purchase')"),
    "upsert_count": (upsert_count, f"""WITH seen AS (SELECT user_id, count(*) AS n, arg_max(event_type, event_id) AS kind,
        count(*) FILTER (event_type = 'view') AS views FROM events GROUP BY user_id)
        SELECT user_id, row_number() OVER (ORDER BY views = 0, {ORDER}) AS uid, kind, n + views AS seen FROM seen"""),
    "delete_keys": (delete_keys, """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (
        SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')"""),
    "delete_prefix": (delete_prefix, "SELECT p_partkey, p_name FROM part WHERE p_name NOT LIKE 'red%'"),
    "update_where": (update_where, """SELECT p_partkey, CASE WHEN p_type = 'SMALL' AND p_brand = 'Brand#4' THEN 'none' ELSE p_brand END AS p_brand,
        p_type, CASE WHEN p_type LIKE '%PROMO%' OR p_type LIKE '%STANDARD%' THEN -1
        WHEN p_type = 'SMALL' AND p_brand = 'Brand#4' THEN 0 ELSE p_size END AS p_size FROM part"""),
    "counter_add": (counter_add, "SELECT event_type AS key, count(*) AS value FROM events GROUP BY event_type"),
    "assigned_ids": (assigned_ids, f"""WITH {VIEWERS}, {BUYERS}, {NUMBERED} SELECT user_id, uid FROM numbered UNION ALL
        SELECT user_id, (SELECT count(*) FROM numbered) + row_number() OVER (ORDER BY {ORDER}) AS uid
        FROM (SELECT DISTINCT user_id FROM buyers WHERE user_id NOT IN (SELECT user_id FROM numbered))"""),
    "replaced_ids": (replaced_ids, f"""WITH {VIEWERS}, {BUYERS}, {NUMBERED}
        SELECT user_id, uid FROM numbered WHERE user_id NOT IN (SELECT user_id FROM buyers) UNION ALL
        SELECT user_id, (SELECT count(*) FROM numbered) + row_number() OVER (ORDER BY {ORDER}) AS uid
        FROM (SELECT DISTINCT user_id FROM buyers)"""),
    "previous_ids": (previous_ids, f"""WITH {VIEWERS}, {BUYERS}, {NUMBERED} SELECT b.user_id, coalesce(uid, 0) AS uid
        FROM (SELECT DISTINCT user_id FROM buyers) b LEFT JOIN numbered USING (user_id)"""),
    "order_page": (order_page, """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
        ORDER BY o_orderkey LIMIT 500 OFFSET 1000"""),
    "order_page_after": (order_page_after, """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_orderkey > 777
        ORDER BY o_orderkey LIMIT 500"""),
}
