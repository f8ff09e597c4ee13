"""DuckDB oracle building blocks: the same adapters as ``cartwheel.sources``
and the enrichment stages, written as SQL CTEs over the pre-registered
views. ``with_ctes('ewp', ...)`` returns a WITH clause with dependencies in
order."""

from __future__ import annotations

CTES: dict[str, tuple[list[str], str]] = {
    "ev": ([], """
  SELECT ts AS "timestamp", user_id AS visitorid,
         CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'addtocart' ELSE 'transaction' END AS event,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS itemid,
         CASE WHEN event_type = 'purchase' THEN CAST(user_id * 1000 + dayofyear(ts) AS BIGINT) END AS transactionid,
         event_id
  FROM events WHERE event_type IN ('view', 'click', 'purchase')"""),
    "props": ([], """
  SELECT ts AS "timestamp", CAST(json_extract_string(props, '$.k') AS BIGINT) AS itemid,
         CASE WHEN event_type = 'signup' THEN '790' WHEN event_id % 2 = 0 THEN 'categoryid' ELSE 'available' END AS property,
         CASE WHEN event_type = 'signup' THEN (CASE WHEN event_id % 17 = 0 THEN 'n0.0' ELSE 'n' || CAST(value AS VARCHAR) END)
              WHEN event_id % 2 = 0 THEN CAST(event_id % 10 AS VARCHAR)
              ELSE CAST(CAST(event_id % 3 = 0 AS INTEGER) AS VARCHAR) END AS value,
         event_id AS ingest_seq
  FROM events WHERE event_type IN ('signup', 'error')"""),
    "snap": (["props"], """
  SELECT itemid, "timestamp",
         max_by(value, ingest_seq) FILTER (WHERE property = 'available') AS available,
         max_by(value, ingest_seq) FILTER (WHERE property = 'categoryid') AS categoryid,
         TRY_CAST(regexp_replace(max_by(value, ingest_seq) FILTER (WHERE property = '790'), '^n', '') AS DOUBLE) AS price
  FROM props WHERE property IN ('790', 'categoryid', 'available') AND value IS NOT NULL
  GROUP BY itemid, "timestamp\""""),
    "item_means": (["snap"], """
  SELECT itemid, avg(price) AS mean_price FROM snap GROUP BY itemid"""),
    "ewp": (["ev", "snap", "item_means"], """
  SELECT e."timestamp", e.visitorid, e.event, e.itemid, e.transactionid, e.event_id,
         s.available, s.categoryid, coalesce(s.price, m.mean_price) AS price, m.mean_price
  FROM ev e ASOF LEFT JOIN snap s ON e.itemid = s.itemid AND e."timestamp" >= s."timestamp"
  LEFT JOIN item_means m ON e.itemid = m.itemid"""),
    "txp": (["ewp"], """
  SELECT t."timestamp", t.visitorid, t.event, t.itemid, t.transactionid,
         CASE WHEN t.price = 0 THEN im.imp ELSE t.price END AS price
  FROM (SELECT * FROM ewp WHERE event = 'transaction') t
  LEFT JOIN (SELECT itemid, avg(price) AS imp FROM ewp WHERE event = 'transaction' AND price > 0 GROUP BY itemid) im
    ON t.itemid = im.itemid
  WHERE (CASE WHEN t.price = 0 THEN im.imp ELSE t.price END) IS NOT NULL"""),
    "btx": ([], """
  SELECT o.o_orderdate AS "timestamp", o.o_custkey AS visitorid, 'transaction' AS event,
         l.l_partkey AS itemid, o.o_orderkey AS transactionid, l.l_extendedprice AS price
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""),
}


def register_cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in CTES[n][0]:
            visit(d)
        out.append(n)
    for n in names:
        visit(n)
    return out


def with_ctes(*names: str) -> str:
    parts = [f"{n} AS ({CTES[n][1]}\n)" for n in _order(list(names))]
    return "WITH " + ",\n".join(parts) + "\n"


# Fixed SQL fragments shared by several oracle queries.
def floor_days_sql(a: str, b: str) -> str:
    """pandas (b - a).dt.days."""
    return f"CAST(floor(date_diff('microsecond', {a}, {b}) / 86400000000.0) AS BIGINT)"


def frac_days_sql(a: str, b: str) -> str:
    return f"(date_diff('microsecond', {a}, {b}) / 86400000000.0)"


def log1p0_sql(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR {x} <= -1 THEN 0.0 ELSE ln(1 + {x}) END)"


def hist_sql(src: str, expr: str, bins: int, where: str = "TRUE", log: bool = False) -> str:
    """Histogram like ``relational.histogram`` over ``expr`` of CTE/view ``src``;
    returns a full SELECT (to be preceded by a WITH clause that defines src)."""
    v = f"SELECT CAST({expr} AS DOUBLE) AS x FROM {src} WHERE ({expr}) IS NOT NULL AND {where}"
    if log:
        v = f"SELECT CASE WHEN x <= -1 THEN 0.0 ELSE ln(1 + x) END AS x FROM ({v}) WHERE x > 0"
    return f"""
SELECT g.bin, lo + g.bin * ((hi - lo) / {bins}) AS bin_lo, lo + (g.bin + 1) * ((hi - lo) / {bins}) AS bin_hi,
       coalesce(c.cnt, 0) AS count
FROM (SELECT range AS bin FROM range({bins})) g
CROSS JOIN (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
                   CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM ({v})) b
LEFT JOIN (SELECT least(CAST(floor((x - lo) / (hi - lo) * {bins}) AS BIGINT), {bins - 1}) AS bin, count(*) AS cnt
           FROM ({v}) vv, (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
                                  CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM ({v})) bb
           WHERE x >= lo AND x <= hi GROUP BY 1) c ON g.bin = c.bin"""


def money_sql(x: str) -> str:
    return (f"(CASE WHEN {x} >= 1e9 THEN printf('%.2f', {x} / 1e9) || 'B' "
            f"WHEN {x} >= 1e6 THEN printf('%.1f', {x} / 1e6) || 'M' "
            f"WHEN {x} >= 1e3 THEN printf('%.0f', {x} / 1e3) || 'k' "
            f"ELSE CAST(CAST(trunc({x}) AS BIGINT) AS VARCHAR) END)")
