"""The derived views as portable SQL (DuckDB and Spark SQL), for the oracle.

``with_views(sql, *names)`` prefixes a query with the CTEs it needs.
"""

from __future__ import annotations

CU = "'North Indian;Chinese;South Indian;Mughlai;Cafe;Bakery;Italian;Fast Food;Continental;Desserts;Biryani;Street Food'"
AR = "'Koramangala;Indiranagar;HSR Layout;Whitefield;JP Nagar;MG Road;Jayanagar;Atlantis'"

VIEWS = {
    "restaurants_raw": f"""
SELECT p.p_partkey AS restaurant_id, concat(p.p_name,' ',p.p_partkey) AS name,
 CASE WHEN p.p_partkey % 17 = 0 THEN 'NEW' WHEN p.p_partkey % 19 = 0 THEN '-' WHEN p.p_partkey % 23 = 0 THEN NULL
      ELSE concat(' ',1 + p.p_size % 4,'.',p.p_partkey % 10,' /5') END AS rate,
 CASE WHEN p.p_partkey % 29 = 0 THEN NULL WHEN p.p_size % 2 = 0 THEN concat(100 + p.p_partkey % 900)
      ELSE concat('₹',1 + p.p_size % 3,',',lpad(concat(p.p_partkey % 1000),3,'0')) END AS cost_text,
 CASE WHEN p.p_partkey % 31 = 0 THEN NULL
      ELSE concat(split_part({CU},';',CAST(1 + p.p_partkey % 12 AS INT)),', ',
                  split_part({CU},';',CAST(1 + p.p_size % 12 AS INT))) END AS cuisines,
 split_part({AR},';',CAST(1 + p.p_partkey % 8 AS INT)) AS location,
 CASE WHEN p.p_size % 3 = 0 THEN 'Yes' WHEN p.p_size % 3 = 1 THEN 'No' END AS online_order,
 CAST(coalesce(v.votes,0) AS BIGINT) AS votes
FROM part p LEFT JOIN (SELECT l_partkey, count(*) AS votes FROM lineitem GROUP BY l_partkey) v
  ON v.l_partkey = p.p_partkey""",
    "deliveries_raw": """
SELECT event_id AS order_id, user_id, ts AS order_ts,
 CASE WHEN event_id % 97 = 0 THEN 'NAN' ELSE concat(5 + event_id % 130,' min') END AS time_text,
 CAST(12.90 + (user_id % 200) / 1000.0 AS DOUBLE) AS restaurant_latitude,
 CAST(77.50 + (user_id % 250) / 1000.0 AS DOUBLE) AS restaurant_longitude,
 CAST(12.90 + (event_id % 211) / 1000.0 AS DOUBLE) AS delivery_latitude,
 CAST(77.50 + (event_id % 241) / 1000.0 AS DOUBLE) AS delivery_longitude,
 CASE WHEN event_id % 10 = 0 THEN 'Yes' WHEN event_id % 10 = 1 THEN NULL ELSE 'No' END AS festival,
 split_part('Low;Medium;High;Jam;Unknown',';',CAST(1 + event_id % 5 AS INT)) AS road_traffic_density,
 CAST(18 + event_id % 40 AS BIGINT) AS courier_age
FROM events""",
    "outcomes": """
SELECT event_id AS order_id, ts, CAST(15 + event_id % 47 AS DOUBLE) AS actual_min,
 CAST(15 + event_id % 47 + (event_id * 7) % 11 - 5 AS DOUBLE) AS predicted_min
FROM events""",
    "interactions": """
SELECT o.o_custkey AS user_id, l.l_partkey AS restaurant_id, avg(1 + (l.l_quantity % 5)) AS rating
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
GROUP BY o.o_custkey, l.l_partkey""",
    "messages": f"""
SELECT conv_id, turn, CASE turn % 6
 WHEN 0 THEN concat('Find ',split_part({CU},';',CAST(1 + conv_id % 12 AS INT)),' food in ',
                    split_part({AR},';',CAST(1 + conv_id % 8 AS INT)))
 WHEN 1 THEN concat('something cheap under ',100 + conv_id % 900)
 WHEN 2 THEN 'How long does delivery from Truffles take?'
 WHEN 3 THEN 'reliability score for Truffles?' WHEN 4 THEN 'namaste' ELSE text END AS message
FROM conversations WHERE role = 'user'""",
}


def with_views(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with CTEs for the named views (plus ``extra`` CTEs, in order)."""
    parts = [f"{n} AS ({VIEWS[n]}\n)" for n in names]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v}\n)")
    if not parts:
        return sql
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        # merge the query's own CTE list into ours
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + sql
