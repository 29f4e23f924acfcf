"""Ordinary SQL handed to the engine as written: any query can be run or exported."""

from __future__ import annotations

from quayside.plans.common import Catalog

catalog = Catalog()

catalog.add_sql("sql_projection", "SELECT l_orderkey, l_quantity, 1 AS one FROM lineitem", "lineitem")
catalog.add_sql(
    "sql_filter",
    "SELECT * FROM lineitem WHERE l_quantity > 40 AND l_returnflag = 'R'",
    "lineitem",
)
catalog.add_sql(
    "sql_in_list",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')",
    "orders",
)
catalog.add_sql(
    "sql_top_n",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    "orders",
)
catalog.add_sql("sql_count", "SELECT count(*) AS n FROM lineitem", "lineitem")
catalog.add_sql(
    "sql_union_all",
    "SELECT c_custkey AS k, c_name AS name FROM customer"
    " UNION ALL SELECT s_suppkey, s_name FROM supplier",
    "customer",
    "supplier",
)
catalog.add_sql(
    "sql_cte",
    "WITH big AS (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)"
    " SELECT o_custkey, count(*) AS n FROM big GROUP BY o_custkey",
    "orders",
)
catalog.add_sql(
    "sql_derived_table",
    "SELECT * FROM (SELECT p_brand, p_size FROM part WHERE p_size < 10) sub",
    "part",
)
catalog.add_sql(
    "pt_join_inner",
    "SELECT o_orderpriority, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines"
    " FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderpriority",
    "orders",
    "lineitem",
)
catalog.add_sql(
    "pt_join_left",
    "SELECT c_custkey, count(o_orderkey) AS orders FROM customer"
    " LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey",
    "customer",
    "orders",
)
catalog.add_sql(
    "pt_semi_anti",
    "SELECT d.doc_id, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)"
    " AS good FROM documents d"
    " WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)",
    "documents",
    "labels",
)
catalog.add_sql(
    "pt_group_by",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines,"
    " min(l_quantity) AS least, max(l_extendedprice) AS most"
    " FROM lineitem GROUP BY l_returnflag, l_linestatus",
    "lineitem",
)
catalog.add_sql(
    "pt_distinct", "SELECT DISTINCT lang, source FROM documents", "documents"
)
catalog.add_sql(
    "pt_rollup",
    "SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY ROLLUP (p_brand, p_size)",
    "part",
)
catalog.add_sql(
    "pt_window",
    "SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS visit,"
    " lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events",
    "events",
)
catalog.add_sql(
    "pt_order_top_k",
    "SELECT n_name, c_custkey, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey"
    " ORDER BY c_acctbal DESC, c_custkey LIMIT 25",
    "customer",
    "nation",
)
catalog.add_sql(
    "pt_intersect_except",
    "(SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer)"
    " EXCEPT SELECT s_suppkey FROM supplier",
    "orders",
    "customer",
    "supplier",
)
catalog.add_sql(
    "pt_scalar",
    "SELECT p_partkey, upper(p_name) AS name, length(p_type) AS n, coalesce(p_size, 0) + 1 AS size,"
    " CASE WHEN p_retailprice > 1000 THEN 'high' ELSE 'low' END AS band,"
    " substr(p_brand, 1, 5) AS brand FROM part",
    "part",
)
