"""Queries on single shredding rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.operators.shred import (
    explode_entries, items, leaf, node, obj, rows, shape, tabulate, texts,
)
from clinloom.operators.typed import typed
from clinloom.workload import bundles
from clinloom.workload.bundles import arr, first_n, order_lines, st
from clinloom.workload.registry import Tables, as_doubles, query


def _json(df: DataFrame, key: str, json: str) -> DataFrame:
    return df.hint("rebalance").selectExpr(f"{key} AS id", f"to_json({json}) AS resource")


@query("q_shred_props", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def shred_props(t: Tables):
    df = tabulate(t.events.select("event_id", "props").hint("rebalance"), shape(leaf("k")), text="props")
    return typed(df, {"k": "int"})


@query("q_shred_array_explode", """
SELECT doc_id AS id, l.line AS line_text
FROM documents, unnest(string_split(text, chr(10))) AS l(line)""")
def shred_array_explode(t: Tables):
    """Whole documents, one JSON array element per line of text."""
    lines = "transform(split(text, '\\n'), x -> named_struct('text', x))"
    return tabulate(_json(t.documents, "doc_id", st(line=lines)), shape(rows("line", leaf("text"))), "line")


@query("q_shred_json_like_text", """
SELECT event_id AS id, props AS whole, '[' || CAST(event_id AS VARCHAR) || ']' AS part, props AS one_text
FROM events""")
def shred_json_like_text(t: Tables):
    """Texts that are themselves JSON stay texts, at every level."""
    df = _json(t.events, "event_id", st(
        whole="props", part="concat('[', event_id, ']')", one=arr(st(text="props")),
    ))
    return tabulate(df, shape(leaf("whole", "part"), rows("one", leaf("text"))), "one")


@query("q_shred_exact_money", """
SELECT l_orderkey AS id, l_linenumber AS n, CAST(l_partkey * 1000000000000 + l_suppkey AS VARCHAR) || '.6789' AS total
FROM lineitem""")
def shred_exact_money(t: Tables):
    """Numbers of more digits than a double holds, inside a bundle."""
    total = "l_partkey * 1000000000000 + l_suppkey"
    docs = t.lineitem.hint("rebalance").selectExpr(
        "l_orderkey AS id", "l_linenumber AS n",
        f"concat('{{\"entry\":[{{\"fullUrl\":\"u\",\"resource\":{{\"resourceType\":\"Claim\",\"total\":{{\"value\":', {total}, '.6789}}}}}}]}}') AS json",
    )
    found = tabulate(explode_entries(docs, "Claim"), shape(obj("total", leaf("value"))))
    return found.select("id", "n", F.col("total_value").alias("total"))


@query("q_shred_outer_empty", """
SELECT o_orderkey AS id, l_linenumber AS item_n
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""")
def shred_outer_empty(t: Tables):
    """An order without lines has an empty array and keeps its row."""
    item = first_n("CASE WHEN l_orderkey IS NULL THEN 0 ELSE 1 END", st(n="l_linenumber"))
    df = _json(order_lines(t), "o_orderkey", st(item=item))
    return typed(tabulate(df, shape(rows("item", leaf("n"))), "item"), {"item_n": "int"})


@query("q_shred_object_or_array", """
SELECT l_orderkey AS id, x.v AS a_v, l_linestatus AS o_w
FROM lineitem,
     unnest(CASE l_returnflag WHEN 'A' THEN [l_partkey] WHEN 'R' THEN [l_partkey, l_suppkey] ELSE [NULL] END) AS x(v),
     unnest(CASE l_linestatus WHEN 'F' THEN [1, 2] ELSE [1] END) AS y(n)""")
def shred_object_or_array(t: Tables):
    """Nodes that are sometimes an object, sometimes an array, sometimes absent."""
    one = "to_json(named_struct('v', l_partkey))"
    two = "to_json(array(named_struct('v', l_partkey), named_struct('v', l_suppkey)))"
    a = f"CASE l_returnflag WHEN 'A' THEN concat('\"a\":', {one}, ',') WHEN 'R' THEN concat('\"a\":', {two}, ',') ELSE '' END"
    w = "named_struct('w', l_linestatus)"
    o = f"CASE l_linestatus WHEN 'F' THEN to_json(array({w}, {w})) ELSE to_json({w}) END"
    df = t.lineitem.hint("rebalance").selectExpr("l_orderkey AS id", f"concat('{{', {a}, '\"o\":', {o}, '}}') AS resource")
    df = tabulate(df, shape(rows("a", leaf("v")), node("o", leaf("w"))), "a")
    return df.select("id", F.col("a_v").try_cast("bigint").alias("a_v"), "o_w")


@query("q_shred_index0", """
SELECT c_custkey AS id,
       CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_name END AS given,
       CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS coding_code
FROM customer""")
def shred_index0(t: Tables):
    """First element of an array that may be empty."""
    n = "CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'MACHINERY' THEN 1 ELSE 2 END"
    df = _json(t.customer, "c_custkey", st(
        given=first_n(n, "c_name", "'second'"),
        coding=first_n(n, st(code="c_mktsegment"), st(code="'second'")),
    ))
    return tabulate(df, shape(texts("given"), items("coding", leaf("code"))))


@query("q_shred_nested_chain", """
SELECT o_orderkey AS id, o_orderpriority AS a_b_c_d_code
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey, unnest([1, 2]) AS x(n)
WHERE l_orderkey IS NOT NULL
UNION ALL
SELECT o_orderkey, NULL FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def shred_nested_chain(t: Tables):
    """Four levels deep; a missing level keeps one row."""
    deep = st(d=arr(st(code="o_orderpriority"), st(code="o_orderpriority")))
    a = first_n("CASE WHEN l_orderkey IS NULL THEN 0 ELSE 1 END", st(b=arr(st(c=arr(deep)))))
    schema = shape(rows("a", rows("b", rows("c", rows("d", leaf("code"))))))
    return tabulate(_json(order_lines(t), "o_orderkey", st(a=a)), schema, "a", "a.b", "a.b.c", "a.b.c.d")


@query("q_shred_sibling_fanout", """
SELECT l_orderkey AS id, x.v AS x_v, y.v AS y_v
FROM lineitem, unnest([l_partkey, l_suppkey]) AS x(v),
     unnest(CASE l_returnflag WHEN 'R' THEN [1, 2, 3] WHEN 'A' THEN [1] ELSE [NULL] END) AS y(v)""")
def shred_sibling_fanout(t: Tables):
    """Independent arrays multiply each other."""
    df = _json(t.lineitem, "l_orderkey", st(
        x=arr(st(v="l_partkey"), st(v="l_suppkey")),
        y=first_n("CASE l_returnflag WHEN 'R' THEN 3 WHEN 'A' THEN 1 ELSE 0 END", *[st(v=str(i)) for i in (1, 2, 3)]),
    ))
    out = tabulate(df, shape(rows("x", leaf("v")), rows("y", leaf("v"))), "x", "y")
    return out.select(
        "id", F.col("x_v").try_cast("bigint").alias("x_v"), F.col("y_v").try_cast("int").alias("y_v")
    )


@query("q_shred_typed_scalars", """
SELECT l_orderkey AS id, l_linenumber AS n, l_quantity AS q,
       CAST(CAST(l_extendedprice AS DECIMAL(19,4)) AS DOUBLE) AS m, l_returnflag = 'R' AS b,
       CAST(l_shipdate AS DATE) AS d, CAST(CAST(l_shipdate AS DATE) + INTERVAL 30 MINUTE AS TIMESTAMP) AS ts,
       CAST(NULL AS INTEGER) AS bad
FROM lineitem""")
def shred_typed_scalars(t: Tables):
    """Numbers and booleans, quoted on some rows; dates with an offset."""
    def quoted(value: str) -> str:
        return f"CASE WHEN l_linestatus = 'F' THEN concat('\"', {value}, '\"') ELSE CAST({value} AS STRING) END"

    body = ", ',', ".join(
        f"'\"{k}\":', {v}" for k, v in {
            "n": quoted("l_linenumber"), "q": quoted("l_quantity"), "m": quoted("l_extendedprice"),
            "b": quoted("l_returnflag = 'R'"),
            "d": f"concat('\"', {bundles.late('l_shipdate')}, '\"')",
            "ts": f"concat('\"', {bundles.early('l_shipdate')}, '\"')",
            "bad": "concat('\"', l_returnflag, '\"')",
        }.items()
    )
    df = t.lineitem.hint("rebalance").selectExpr("l_orderkey AS id", f"concat('{{', {body}, '}}') AS resource")
    kinds = {"n": "int", "q": "double", "m": "money", "b": "boolean", "d": "date", "ts": "timestamp", "bad": "int"}
    return as_doubles(typed(tabulate(df, shape(leaf(*kinds))), kinds), "m")


@query("q_shred_lax_scalars", """
SELECT l_orderkey AS id, CASE WHEN l_returnflag = 'A' THEN '[' || l_linestatus END AS s,
       CASE WHEN l_returnflag = 'N' THEN l_linestatus END AS p_x
FROM lineitem""")
def shred_lax_scalars(t: Tables):
    """A scalar asked of an object or array is NULL; a path through a non-object too."""
    s = "CASE l_returnflag WHEN 'A' THEN concat('\"[', l_linestatus, '\"') WHEN 'R' THEN '[1,2]' ELSE '{\"z\":1}' END"
    p = "CASE l_returnflag WHEN 'N' THEN to_json(named_struct('x', l_linestatus)) WHEN 'R' THEN '[{\"x\":1}]' ELSE '\"x\"' END"
    df = t.lineitem.hint("rebalance").selectExpr("l_orderkey AS id", f"concat('{{\"s\":', {s}, ',\"p\":', {p}, '}}') AS resource")
    return tabulate(df, shape(leaf("s"), obj("p", leaf("x"))))


@query("q_entries_by_type", """
SELECT o_orderkey AS doc_id, 'urn:uuid:' || CAST(o_orderkey AS VARCHAR) AS fullUrl, 'Encounter' AS resourceType,
       o_orderstatus AS x, CAST(NULL AS VARCHAR) AS status
FROM orders
UNION ALL SELECT o_orderkey, 'urn:uuid:other', 'Observation', NULL, 'final' FROM orders""")
def entries_by_type(t: Tables):
    """All entries of all documents, with the type read ahead of the resource."""
    docs = bundles.documents(t.orders, "o_orderkey", bundles.entry("o_orderkey", "Encounter", x="o_orderstatus"))
    return explode_entries(docs).select(
        "doc_id", "fullUrl", "resourceType", F.try_variant_get("resource", "$.x", "string").alias("x"),
        F.try_variant_get("resource", "$.status", "string").alias("status"),
    )
