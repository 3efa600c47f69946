"""DuckDB twins of the fixture tables (FIXTURES.md §2), as composable CTEs.

``with_ctes(["clicks", "users"], body)`` prefixes ``body`` with the CTEs it
needs (dependencies are pulled in automatically, in definition order).
"""

from __future__ import annotations

# md5-derived 60-bit hash; identical to cartwheel.functions.exprs.h64.
def h64_sql(*parts: str) -> str:
    joined = " || '-' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(('0x' || substr(md5({joined}), 1, 15)) AS BIGINT)"


def fixed_sql(x: str) -> str:
    """Twin of cartwheel.functions.exprs.fixed."""
    return f"CAST(floor(({x}) * 17592186044416.0) AS BIGINT)"


def unfixed_sql(x: str) -> str:
    return f"({x} / 17592186044416.0)"


_CTES: dict[str, tuple[list[str], str]] = {
    "clicks": ([], """
  SELECT CAST(user_id AS BIGINT) AS user_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS sku_id,
         CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 WHEN 'click' THEN 3
                              WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END AS TINYINT) AS type,
         ts AS action_time,
         CAST(event_id AS BIGINT) AS event_id
  FROM events"""),
    "purchases": ([], """
  SELECT CAST(o_custkey AS BIGINT) AS user_id, CAST(l_partkey AS BIGINT) AS sku_id,
         CAST((l_linenumber - 1) % 5 + 1 AS TINYINT) AS type,
         o_orderdate AS action_time,
         CAST(l_orderkey * 100 + l_linenumber AS BIGINT) AS event_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "users": ([], """
  SELECT CAST(c_custkey AS BIGINT) AS user_id,
         CAST(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
                                WHEN 'HOUSEHOLD' THEN 4 WHEN 'MACHINERY' THEN 5 END AS TINYINT) AS age,
         CAST(c_custkey % 2 AS TINYINT) AS sex,
         CAST(c_nationkey AS SMALLINT) AS city,
         CAST(c_nationkey * 100 + c_custkey % 10 AS INTEGER) AS county
  FROM customer"""),
    "products": ([], """
  SELECT CAST(p_partkey AS BIGINT) AS sku_id,
         CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) AS brand,
         CAST(p_partkey % 10 AS BIGINT) AS shop_id,
         CAST(CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
                          WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END AS SMALLINT) AS cate
  FROM part"""),
    "shops": ([], """
  SELECT CAST(s_suppkey AS BIGINT) AS shop_id,
         CAST(s_nationkey * 1000 + s_suppkey AS INTEGER) AS fans_num,
         CAST(s_acctbal AS DOUBLE) AS shop_score
  FROM supplier"""),
    "enriched_clicks": (["clicks", "products", "users"], """
  SELECT a.user_id, a.sku_id, a.type, a.action_time, a.event_id,
         p.brand, p.shop_id, p.cate, u.age, u.city
  FROM clicks a LEFT JOIN products p ON a.sku_id = p.sku_id
                LEFT JOIN users u ON a.user_id = u.user_id"""),
    "enriched_purchases": (["purchases", "products", "users"], """
  SELECT a.user_id, a.sku_id, a.type, a.action_time, a.event_id,
         p.brand, p.shop_id, p.cate, u.age, u.city
  FROM purchases a LEFT JOIN products p ON a.sku_id = p.sku_id
                   LEFT JOIN users u ON a.user_id = u.user_id"""),
}


def define(name: str, deps: list[str], body: str) -> None:
    """Add a derived CTE usable by later queries."""
    _CTES[name] = (deps, body)


def _resolve(names: list[str], out: list[str]) -> None:
    for n in names:
        deps, _ = _CTES[n]
        _resolve(deps, out)
        if n not in out:
            out.append(n)


def with_ctes(names: list[str], body: str, local: list[tuple[str, str]] | None = None) -> str:
    """WITH <fixture CTEs>, <local CTEs> <body>."""
    order: list[str] = []
    _resolve(names, order)
    parts = [f"{n} AS ({_CTES[n][1]}\n)" for n in order]
    parts += [f"{n} AS (\n{sql.strip()}\n)" for n, sql in (local or [])]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
