"""DuckDB twins of the derived views (oracle side), kept next to nothing Spark-specific.

The oracle must compute the same values independently, from the columns, so
these fragments restate the FIXTURES recipes in plain SQL.
"""

from __future__ import annotations

from quarry.sources.derived import ES_TYPE, STATUS_BY_TYPE


def h(expr: str) -> str:
    """F1 stable hash in DuckDB."""
    return f"CAST(('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8)) AS BIGINT)"


def case_map(col: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v if isinstance(v, int) else repr(v)}" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


STATUS = case_map("event_type", STATUS_BY_TYPE)
ES = case_map("event_type", ES_TYPE)
K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

EX = f"""ex AS (
  SELECT *, {K} AS k, '/st/' || CAST({K} AS VARCHAR) AS path, event_type = 'view' AS is_view,
         CAST(event_id % 4 AS INTEGER) AS server, CAST({h('user_id')} % 6 AS INTEGER) AS kpart,
         CAST({STATUS} AS INTEGER) AS status
  FROM events)"""

ARRIVAL = f"(epoch_us(ts) + ({h('event_id')} % 28800) * 1000000)"


def iso_millis(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


ESLOG = f"""eslog AS (
  SELECT event_id AS seq, {iso_millis('ts')} AS time, {ES} AS type, user_id AS photo_id,
         k AS es_user,
         CASE WHEN event_type IN ('signup', 'purchase') THEN '/st/' || CAST(event_id AS VARCHAR) END AS es_path,
         CASE WHEN event_type = 'click' THEN 't' || CAST(k AS VARCHAR) END AS es_title,
         CASE WHEN event_type = 'purchase' THEN
           CASE WHEN k % 5 = 0 THEN '/undo' ELSE '/filter/f' || CAST(k % 7 AS VARCHAR) END END AS operation
  FROM ex WHERE event_type <> 'view')"""

SPANS = """spans AS (
  SELECT l_orderkey AS trace_id, l_linenumber AS span_no, l_returnflag AS name,
         'host-' || CAST(l_suppkey % 3 AS VARCHAR) AS host, l_shipdate AS start,
         l_shipdate + to_microseconds(CAST(round(l_quantity * 1000000) AS BIGINT)) AS "end",
         l_quantity AS duration_s, l_partkey, l_suppkey, l_extendedprice
  FROM lineitem)"""

PHOTO_DOC = """doc AS (
  SELECT o_orderkey AS photo_id, '/st/u' || CAST(o_custkey AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR) || '.jpg' AS path,
         o_orderdate AS upload_date, o_totalprice AS size,
         CASE o_orderstatus WHEN 'F' THEN 'jpeg' WHEN 'O' THEN 'heic' WHEN 'P' THEN 'png' END AS format,
         CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'Order ' || CAST(o_orderkey AS VARCHAR) END AS title,
         string_split(lower(regexp_replace(o_orderpriority, '^\\d-', '')), ' ') AS objects,
         o_custkey AS user_id, c_name AS account_name, c_mktsegment AS segment,
         CAST(nullif(o_orderkey % 25, 0) AS INTEGER) AS camera_id, n_name AS manufacturer
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON nullif(o_orderkey % 25, 0) = n_nationkey)"""


def positioned_sql(src: str, keys: str, item: str, name: str, distinct: bool = True) -> str:
    """Twin of ``positioned``: ``SELECT keys, pos, name`` over ``src`` (a subquery or table)."""
    d = "DISTINCT " if distinct else ""
    return f"""(SELECT {keys}, row_number() OVER (PARTITION BY {keys} ORDER BY _it) - 1 AS pos, _it AS {name}
      FROM (SELECT {d}{keys}, {item} AS _it FROM {src}))"""
