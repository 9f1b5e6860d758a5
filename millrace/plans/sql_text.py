"""Query cases: SQL text over the tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.registry import Tables, case


def _add_sql(name: str, text: str, duck: str | None = None, **args) -> None:
    """The same text for both engines; `{orders}` stands for a table in Spark's."""
    plain = re.sub(r"\{(\w+)\}", r"\1", text)

    @case(name, duck or plain)
    def build(t: Tables) -> DataFrame:
        return t.sql(text, **({"args": args} if args else {}))


_add_sql("q_sql_cte", """
WITH per AS (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS total FROM {orders} GROUP BY o_custkey), big AS (SELECT * FROM per WHERE n > 10)
SELECT c_mktsegment, count(*) AS customers, round(sum(total), 2) AS total FROM big JOIN {customer} ON o_custkey = c_custkey GROUP BY c_mktsegment""")

_add_sql("q_sql_correlated_scalar", """
SELECT c_custkey, (SELECT max(o_totalprice) FROM {orders} WHERE o_custkey = c_custkey) AS top FROM {customer}""")

_add_sql("q_sql_in_subquery", """
SELECT o_orderkey FROM {orders} WHERE o_custkey IN (SELECT c_custkey FROM {customer} WHERE c_mktsegment = 'MACHINERY') AND o_orderkey NOT IN (SELECT l_orderkey FROM {lineitem} WHERE l_quantity > 40)""")

_add_sql("q_sql_exists", """
SELECT c_custkey FROM {customer} WHERE EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_totalprice > 450000)
AND NOT EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_totalprice < 5000)""")

_add_sql("q_sql_grouping_sets", """
SELECT l_returnflag, l_linestatus, count(*) AS n FROM {lineitem} GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())""")

_add_sql("q_sql_lateral", """
SELECT c_custkey, top.best, top.n FROM {customer}, LATERAL (SELECT max(o_totalprice) AS best, count(*) AS n FROM {orders} WHERE o_custkey = c_custkey) AS top""")

_add_sql("q_sql_values", """
SELECT v.label, count(*) AS n FROM {orders} JOIN (VALUES ('F', 'done'), ('O', 'open')) AS v (code, label) ON o_orderstatus = v.code GROUP BY v.label""")

_add_sql("q_sql_pivot", """
SELECT * FROM (SELECT o_orderpriority, o_orderstatus, o_orderkey FROM {orders}) PIVOT (count(o_orderkey) FOR o_orderstatus IN ('F' AS f, 'O' AS o))""",
         """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o FROM orders GROUP BY 1""")

_add_sql("q_sql_unpivot", """
SELECT s_suppkey, what, amount FROM (SELECT s_suppkey, s_acctbal AS bal, s_acctbal * 2 AS twice FROM {supplier}) UNPIVOT (amount FOR what IN (bal, twice))""",
         "SELECT s_suppkey, 'bal' AS what, s_acctbal AS amount FROM supplier UNION ALL SELECT s_suppkey, 'twice', s_acctbal * 2 FROM supplier")

_add_sql("q_sql_set_operations", """
(SELECT o_custkey AS k FROM {orders} WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'P')
EXCEPT SELECT o_custkey FROM {orders} WHERE o_totalprice > 490000""")

_add_sql("q_sql_window_clause", """
SELECT conv_id, turn, row_number() OVER w AS rn, length(text) - lag(length(text)) OVER w AS change FROM {conversations} WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""",
         """SELECT conv_id, turn, CAST(row_number() OVER w AS INTEGER) AS rn, CAST(length(text) - lag(length(text)) OVER w AS INTEGER) AS change FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")

_add_sql("q_sql_named_parameters", "SELECT o_orderstatus, count(*) AS n FROM {orders} WHERE o_totalprice > :low AND o_orderpriority = :kind GROUP BY o_orderstatus",
         "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 200000 AND o_orderpriority = '1-URGENT' GROUP BY 1", low=200000, kind="1-URGENT")

_add_sql("q_sql_returned_item_report", """
SELECT c_custkey, c_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM {customer} JOIN {orders} ON c_custkey = o_custkey JOIN {lineitem} ON l_orderkey = o_orderkey
WHERE l_returnflag = 'R' AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' GROUP BY c_custkey, c_name ORDER BY revenue DESC, c_custkey LIMIT 20""")

_add_sql("q_sql_case_filter_agg", """
SELECT o_orderstatus, count(*) FILTER (WHERE o_totalprice > 250000) AS big, sum(CASE WHEN o_orderpriority LIKE '1%' THEN 1 ELSE 0 END) AS urgent FROM {orders} GROUP BY o_orderstatus""",
         """SELECT o_orderstatus, count(*) FILTER (WHERE o_totalprice > 250000) AS big, CAST(sum(CASE WHEN o_orderpriority LIKE '1%' THEN 1 ELSE 0 END) AS BIGINT) AS urgent FROM orders GROUP BY 1""")


@case("q_sql_frame_argument", "SELECT user_id, count(*) AS n FROM events WHERE value > 100 GROUP BY 1")
def sql_frame_argument(t: Tables) -> DataFrame:
    """A frame and a column of Python scope inside the text."""
    big = t.events.where(F.col("value") > 100)
    return t.spark.sql("SELECT {who}, count(*) AS n FROM {big} GROUP BY {who}", big=big, who=big.user_id)
