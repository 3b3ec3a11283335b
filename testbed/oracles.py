"""The same queries as SQL, written from the definitions and sharing nothing with the operators."""

from __future__ import annotations

# Thresholds and score parameters of the two modes.
_ALPHA = {"purchase": "0.2e0", "order": "0.1e0"}
_K = 40

_LINES = """
lines AS (
    SELECT c_mktsegment AS client, CAST(o_custkey AS VARCHAR) AS user_id,
           CAST(o_orderkey AS VARCHAR) AS order_id, CAST(l_suppkey AS VARCHAR) AS item,
           CAST(l_partkey AS VARCHAR) AS part
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
)"""

_ITEMS = """
items AS (
    SELECT unnest(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']) AS client,
           CAST(s_suppkey AS VARCHAR) AS item
    FROM supplier
    WHERE s_suppkey % 10 <= 8
)"""

_ORDER_LINK = "CAST(length(user_id) AS VARCHAR) || ':' || user_id || ':' || order_id"

_VALID = {
    "purchase": """
valid AS (
    SELECT DISTINCT l.client, l.user_id AS link, l.item
    FROM lines l JOIN items i ON l.client = i.client AND l.item = i.item
)""",
    "order": f"""
valid AS (
    SELECT DISTINCT l.client, l.user_id, {_ORDER_LINK} AS link, l.item
    FROM lines l JOIN items i ON l.client = i.client AND l.item = i.item
)""",
}

_LINK_FREQ = {
    "purchase": """
link_freq AS (SELECT client, link, count(DISTINCT item) AS ufrq FROM valid GROUP BY client, link)""",
    "order": """
link_freq AS (
    SELECT DISTINCT v.client, v.user_id, v.link, t.ufrq
    FROM valid v
    JOIN (SELECT client, user_id, count(item) AS ufrq FROM valid GROUP BY client, user_id) t
      ON v.client = t.client AND v.user_id = t.user_id
)""",
}

_ITEM_FREQ = """
item_freq AS (SELECT client, item, count(DISTINCT link) AS freq FROM valid GROUP BY client, item)"""


def _pruned(cap: int) -> str:
    return f"""
pruned AS (
    SELECT DISTINCT v.client, v.link, v.item
    FROM valid v
    JOIN link_freq u ON v.client = u.client AND v.link = u.link AND u.ufrq BETWEEN 2 AND {cap}
    JOIN item_freq f ON v.client = f.client AND v.item = f.item AND f.freq > 1
)"""


_EDGES = """
pairs AS (
    SELECT a.client, a.item AS item_ref, b.item AS item_rec, count(*) AS amf,
           round(sum(2e0 / u.ufrq), 12) AS nmf
    FROM pruned a
    JOIN pruned b ON a.client = b.client AND a.link = b.link AND a.item < b.item
    JOIN link_freq u ON a.client = u.client AND a.link = u.link
    GROUP BY a.client, a.item, b.item
),
edges AS (
    SELECT p.client, p.item_ref, p.item_rec, p.amf, p.nmf, r.freq AS freq_ref, c.freq AS freq_rec
    FROM pairs p
    JOIN item_freq r ON p.client = r.client AND p.item_ref = r.item
    JOIN item_freq c ON p.client = c.client AND p.item_rec = c.item
    WHERE p.amf >= 2.1e0 AND p.nmf >= 0.4e0
)"""

_MIRRORED = """
mirrored AS (
    SELECT client, item_ref, item_rec, amf, nmf, freq_ref, freq_rec FROM edges
    UNION ALL
    SELECT client, item_rec, item_ref, amf, nmf, freq_rec, freq_ref FROM edges
)"""


def _ranked(mode: str, k: int) -> str:
    return f"""
scored AS (
    SELECT *, nmf / (freq_ref * power(freq_rec, {_ALPHA[mode]}))
              * 2e0 / (1e0 + exp(-2e0 * (100e0 * nmf * freq_ref / power(freq_rec, 2e0) - 1e0))) AS asl
    FROM mirrored
),
ranked AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY client, item_ref ORDER BY asl DESC, item_rec DESC) AS rank
        FROM scored
    ) WHERE rank <= {k}
),
normal AS (
    SELECT *, asl / max(asl) OVER (PARTITION BY client, item_ref) AS nsl FROM ranked
)"""


def _sql(select: str, *ctes: str) -> str:
    return "WITH" + ",".join(ctes) + "\n" + select


def _to_valid(mode: str) -> tuple[str, ...]:
    return _LINES, _ITEMS, _VALID[mode]


def _to_edges(mode: str) -> tuple[str, ...]:
    return *_to_valid(mode), _LINK_FREQ[mode], _ITEM_FREQ, _pruned(1000), _EDGES


def _to_ranked(mode: str) -> tuple[str, ...]:
    return *_to_edges(mode), _MIRRORED, _ranked(mode, _K)


def _micro(column: str) -> str:
    return f"CAST(round({column} * 1e6) AS BIGINT) AS {column}_u"


_EDGE_SELECT = f"SELECT client, item_ref, item_rec, amf, {_micro('nmf')}, freq_ref, freq_rec FROM "
_FLAT_SELECT = (
    f"SELECT client, item_ref, item_rec, amf, {_micro('nmf')}, freq_ref, freq_rec, {_micro('asl')}, "
    f"rank, {_micro('nsl')} FROM normal"
)


_POSITION = "row_number() OVER (PARTITION BY client, item_ref ORDER BY asl DESC, item_rec DESC) - 1 AS pos"
_MEMBERS = (
    f"item_rec AS rec, amf, {_micro('nmf')}, freq_rec, freq_ref, {_micro('asl')}, {_micro('nsl')}"
)


def _documents(mode: str) -> str:
    return f"""SELECT client, item_ref AS product, 0.4e0 AS t_nmf, {_ALPHA[mode]} AS t_alpha, 2e0 AS t_adjust, 2.1e0 AS t_amf,
       {_POSITION}, {_MEMBERS}
FROM normal"""


_PART_ROWS = "\nvalid AS (SELECT DISTINCT client, user_id AS link, part AS item FROM lines)"

ORACLES: dict[str, str] = {
    "item_filter": _sql("SELECT client, item FROM items", _ITEMS),
    "explode_purchase": _sql("SELECT client, user_id AS link, item FROM lines", _LINES),
    "explode_order": _sql(f"SELECT client, user_id, {_ORDER_LINK} AS link, item FROM lines", _LINES),
    "valid_events": _sql("SELECT client, link, item FROM valid", *_to_valid("purchase")),
    "valid_events_by_bloom_filter": _sql("SELECT client, link, item FROM valid", *_to_valid("purchase")),
    "user_freq_purchase": _sql(
        "SELECT client, link, ufrq FROM link_freq", *_to_valid("purchase"), _LINK_FREQ["purchase"]
    ),
    "user_freq_order": _sql(
        "SELECT client, user_id, link, ufrq FROM link_freq", *_to_valid("order"), _LINK_FREQ["order"]
    ),
    "item_freq": _sql("SELECT client, item, freq FROM item_freq", *_to_valid("purchase"), _ITEM_FREQ),
    "frequency_pruning": _sql(
        "SELECT client, link, item FROM pruned",
        _LINES,
        _PART_ROWS,
        _LINK_FREQ["purchase"],
        _ITEM_FREQ,
        _pruned(30),
    ),
    "cooccurrence": _sql(_EDGE_SELECT + "edges", *_to_edges("purchase")),
    "cooccurrence_order": _sql(_EDGE_SELECT + "edges", *_to_edges("order")),
    "cooccurrence_order_buckets": _sql(_EDGE_SELECT + "edges", *_to_edges("order")),
    "mirror": _sql(_EDGE_SELECT + "mirrored", *_to_edges("order"), _MIRRORED),
    "asl_score": _sql(
        f"SELECT client, item_ref, item_rec, {_micro('asl')} FROM scored", *_to_ranked("purchase")
    ),
    "rank_topk": _sql("SELECT client, item_ref, item_rec, rank FROM ranked", *_to_ranked("purchase")),
    "nsl": _sql(f"SELECT client, item_ref, item_rec, {_micro('nsl')} FROM normal", *_to_ranked("purchase")),
    "results_array": _sql(f"SELECT client, item_ref, {_POSITION}, {_MEMBERS} FROM normal", *_to_ranked("purchase")),
    "formatted_output": _sql(_documents("purchase"), *_to_ranked("purchase")),
    "purchase_documents": _sql(_documents("purchase"), *_to_ranked("purchase")),
    "buyorder_documents": _sql(_documents("order"), *_to_ranked("order")),
    "purchase_topk": _sql(_FLAT_SELECT, *_to_ranked("purchase")),
    "buyorder_topk": _sql(_FLAT_SELECT, *_to_ranked("order")),
    "purchase_dated_run": _sql(_documents("purchase"), *_to_ranked("purchase")),
    "buyorder_dated_run": _sql(_documents("order"), *_to_ranked("order")),
    "purchase_dated_run_by_client": _sql(_documents("purchase") + " WHERE client = 'BUILDING'", *_to_ranked("purchase")),
    "catalog_snapshot": """SELECT unnest(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']) AS client,
       CAST(s_suppkey AS VARCHAR) AS product_id,
       CASE WHEN s_suppkey % 10 <= 6 THEN 'AVAILABLE' WHEN s_suppkey % 10 <= 8 THEN 'UNAVAILABLE' ELSE 'REMOVED' END AS status
FROM supplier""",
    "trailing_months": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month
FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-05-01 00:00:00' AND o_orderdate < TIMESTAMP '1998-06-01 00:00:00'""",
    "latest_snapshot": """WITH dated AS (
    SELECT strftime(date_trunc('month', o_orderdate), '%Y%m%d-%H%M%S') AS generation,
           month(o_orderdate) AS m, o_orderkey
    FROM orders
)
SELECT generation, o_orderkey FROM dated
WHERE generation = (SELECT max(generation) FROM dated WHERE m % 6 <> 0 AND generation <= '19980615-000000')""",
    "latest_partition": """WITH dated AS (
    SELECT strftime(date_trunc('month', o_orderdate), '%Y%m%d-%H%M%S') AS generation, o_orderkey FROM orders
)
SELECT generation, o_orderkey FROM dated
WHERE generation = (SELECT max(generation) FROM dated WHERE generation <= '19980615-000000')""",
    "json_roundtrip": _sql("SELECT client, user_id AS link, item FROM lines", _LINES),
    "bound": """SELECT event_id, CASE WHEN value >= 0
       THEN CAST(round(ln(1e0 + value) / (1e0 + ln(1e0 + value)) * 1e6) AS BIGINT) END AS b_u
FROM events""",
}
