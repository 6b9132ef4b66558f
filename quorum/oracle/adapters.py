"""The fixture adapters of ``quorum.sources.adapters`` written again as DuckDB CTEs.

Rules are the same fixed values (see that module); the code is SQL over the driver's
pre-registered views (events, orders, lineitem, customer, supplier, nation, region).
"""

from __future__ import annotations


def root(k: str) -> str:
    return f"('0x' || md5(({k}) || 'a') || md5(({k}) || 'b'))"


def state_root(r: str) -> str:
    return f"('0x' || md5('s' || ({r})) || md5('t' || ({r})))"


def address(prefix: str, k: str) -> str:
    return f"('0x' || substr(md5('{prefix}' || CAST({k} AS VARCHAR)), 1, 40))"


def key(*parts: str) -> str:
    """Portable surrogate key: first 15 hex digits of md5 over '|'-joined parts."""
    def escaped(p: str) -> str:
        return f"coalesce(replace(replace(CAST({p} AS VARCHAR), '\\', '\\\\'), '|', '\\|'), '\\N')"

    joined = ", ".join(escaped(p) for p in parts)
    return f"CAST('0x' || substr(md5(concat_ws('|', {joined})), 1, 15) AS BIGINT)"


def set_str(x: str) -> str:
    """Sorted distinct non-NULL values of a group, as text, joined by ','."""
    return f"array_to_string(list_sort(list_distinct(list(CAST({x} AS VARCHAR)))), ',')"


def list_set_str(lst: str) -> str:
    return f"array_to_string(list_sort(list_distinct(CAST({lst} AS VARCHAR[]))), ',')"


RUN_TS = "TIMESTAMP '2024-02-01 00:00:00'"

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


_cte("base", (), """
SELECT event_id, ts, user_id, event_type, value, slot,
       make_timestamp(slot * 21600000000) AS slot_start_date_time,
       slot // 4 AS epoch,
       make_timestamp((slot // 4) * 86400000000) AS epoch_start_date_time,
       CASE WHEN event_id % 4 = 0 THEN 'holesky' ELSE 'mainnet' END AS meta_network_name,
       CASE event_type WHEN 'click' THEN 'prysm' WHEN 'view' THEN 'teku'
            WHEN 'error' THEN 'lodestar' WHEN 'purchase' THEN 'lighthouse'
            WHEN 'signup' THEN 'nimbus' END AS meta_consensus_implementation,
       CASE WHEN event_id % 11 = 0 THEN 'B' ELSE 'A' END AS variant
FROM (SELECT *, epoch_us(ts) // 21600000000 AS slot FROM events)
""")

_VOTE = f"""
       {root("CAST(slot AS VARCHAR) || '/' || variant")} AS beacon_block_root,
       epoch - 1 AS source_epoch, {root("CAST(epoch - 1 AS VARCHAR) || '/S'")} AS source_root,
       epoch AS target_epoch, {root("CAST(epoch AS VARCHAR) || '/T'")} AS target_root"""

_cte("att", ("base",), f"""
SELECT ts AS event_date_time, slot, slot_start_date_time,
       (epoch_us(ts) - epoch_us(slot_start_date_time)) // 1000 AS propagation_slot_start_diff,
       CAST(user_id // 32 AS VARCHAR) AS committee_index,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id END AS attesting_validator_index,
       {_VOTE},
       epoch, epoch_start_date_time,
       g.country AS meta_client_geo_country, g.continent AS meta_client_geo_continent_code,
       meta_network_name, meta_consensus_implementation
FROM base
LEFT JOIN (SELECT c.c_custkey, n.n_name AS country, r.r_name AS continent
           FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                           JOIN region r ON n.n_regionkey = r.r_regionkey) g
       ON user_id = g.c_custkey
""")

_cte("attd", ("base",), f"""
SELECT ts AS event_date_time, slot, slot_start_date_time, epoch, epoch_start_date_time,
       CAST(user_id // 32 AS VARCHAR) AS committee_index, {_VOTE},
       meta_network_name, meta_consensus_implementation
FROM base
""")

_cte("committee", ("base",), """
SELECT s.slot, s.slot_start_date_time, s.epoch, s.epoch_start_date_time, m.committee_index,
       s.meta_network_name, v.validators, v.meta_client_name
FROM (SELECT DISTINCT slot, slot_start_date_time, epoch, epoch_start_date_time, meta_network_name
      FROM base) s
JOIN (SELECT epoch, meta_network_name, CAST(user_id // 32 AS VARCHAR) AS committee_index,
             list_sort(list(DISTINCT user_id)) AS members
      FROM base GROUP BY epoch, meta_network_name, CAST(user_id // 32 AS VARCHAR)) m
  ON s.epoch = m.epoch AND s.meta_network_name = m.meta_network_name,
LATERAL (SELECT m.members AS validators, 'sentry-1' AS meta_client_name
         UNION ALL
         SELECT list_slice(m.members, 2, len(m.members)), 'sentry-2') v
""")

_cte("cls_raw", ("base",), """
SELECT ts AS updated_date_time, slot, slot_start_date_time,
       CASE WHEN event_type = 'signup' THEN '' ELSE upper(meta_consensus_implementation) END
         AS best_guess_single,
       CASE WHEN event_id % 5 = 0 THEN user_id ELSE -user_id - 1 END AS proposer_index,
       meta_network_name
FROM base
""")

_cte("cls", ("cls_raw",), """
SELECT * FROM cls_raw
QUALIFY row_number() OVER (PARTITION BY slot, proposer_index, meta_network_name
                           ORDER BY updated_date_time DESC, best_guess_single DESC) = 1
""")

_cte("event_block", ("base",), f"""
SELECT ts AS event_date_time, slot, slot_start_date_time, epoch,
       {root("CAST(slot AS VARCHAR) || '/' || variant")} AS block, meta_network_name
FROM base WHERE (CASE WHEN slot % 6 = 0 THEN FALSE WHEN slot % 6 = 3 THEN TRUE ELSE event_type IN ('click', 'view') END)
""")

_cte("gossip_block", ("base",), f"""
SELECT event_id AS unique_key, ts + to_days(v.d) AS updated_date_time, slot, slot_start_date_time, epoch,
       {root("CAST(slot AS VARCHAR) || '/' || CASE WHEN v.d = 0 THEN 'D' WHEN event_id % 13 = 0 THEN 'C' ELSE 'A' END")}
         AS block, meta_network_name
FROM base, (VALUES (0), (1)) v(d) WHERE NOT (CASE WHEN slot % 6 = 0 THEN FALSE WHEN slot % 6 = 3 THEN TRUE ELSE event_type IN ('click', 'view') END)
""")

_cte("gossip_block_final", ("gossip_block",), """
SELECT * FROM gossip_block
QUALIFY row_number() OVER (PARTITION BY unique_key ORDER BY updated_date_time DESC) = 1
""")

_cte("canonical_block", ("base",), f"""
SELECT s.slot_start_date_time + to_days(v.d) AS updated_date_time, s.slot,
       s.slot_start_date_time, s.epoch, {root("CAST(s.slot AS VARCHAR) || '/A'")} AS block_root,
       v.version AS block_version,
       {state_root(root("CAST(s.slot AS VARCHAR) || '/A'"))} AS state_root, s.meta_network_name
FROM (SELECT DISTINCT slot, slot_start_date_time, epoch, meta_network_name FROM base) s,
     (VALUES (1, 'deneb'), (2, 'electra')) v(d, version)
WHERE s.slot % 7 <> 0
""")

_cte("canonical_block_final", ("canonical_block",), """
SELECT * FROM canonical_block
QUALIFY row_number() OVER (PARTITION BY slot, block_root, meta_network_name
                           ORDER BY updated_date_time DESC) = 1
""")

_cte("purchases", ("base",), "SELECT *, slot % 6 AS part FROM base WHERE event_type = 'purchase'")


def _blob_versions(where: str) -> str:
    """Two versions of each row; the older one has another blob index."""
    return f"""
  SELECT p.*, v.latest, ts + to_days(CASE WHEN v.latest THEN 1 ELSE 0 END) AS updated_date_time,
         CASE WHEN v.latest THEN event_id % 6 ELSE 9 END AS idx
  FROM purchases p, (VALUES (FALSE), (TRUE)) v(latest) WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts + to_days(CASE WHEN v.latest THEN 1 ELSE 0 END) DESC) = 1"""


_cte("event_blob", ("purchases",), f"""
SELECT slot, slot_start_date_time, epoch,
       {root("CAST(slot AS VARCHAR) || '/' || variant")} AS block_root,
       CAST(event_id % 6 AS DECIMAL(20, 0)) AS blob_index, meta_network_name
FROM purchases WHERE part IN (0, 1, 4)
""")

_cte("canonical_blob_final", ("purchases",), f"""
SELECT slot, slot_start_date_time, epoch, {root("CAST(slot AS VARCHAR) || '/A'")} AS block_root,
       CAST(idx AS DECIMAL(20, 0)) AS blob_index, meta_network_name
FROM ({_blob_versions("part IN (1, 2, 5)")})
""")

_cte("gossip_blob_final", ("purchases",), f"""
SELECT slot, slot_start_date_time, epoch,
       {state_root(root("CAST(slot AS VARCHAR) || '/' || variant"))} AS state_root,
       idx AS blob_index, meta_network_name
FROM ({_blob_versions("part IN (2, 3, 4, 5)")})
""")

_cte("api_block", ("base",), f"""
SELECT slot, {root("CAST(slot AS VARCHAR) || '/' || variant")} AS block_root,
       {state_root(root("CAST(slot AS VARCHAR) || '/' || variant"))} AS state_root,
       meta_network_name
FROM base WHERE event_type <> 'purchase' OR slot % 6 <> 3
""")

# ---- transactions --------------------------------------------------------------------------
_ORDER_TX = f"""
       {root("'tx' || CAST(o_orderkey AS VARCHAR)")} AS hash,
       {address("f", "o_custkey")} AS "from",
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE {address("t", "o_orderkey")} END AS "to",
       CAST(o_orderkey AS DECIMAL(20, 0)) AS nonce,
       CAST(round(o_totalprice) AS DECIMAL(38, 0)) AS gas_price,
       CAST(21000 + length(o_orderpriority) * 1000 AS DECIMAL(20, 0)) AS gas,
       CAST(round(o_totalprice * 100) AS DECIMAL(38, 0)) AS value,
       CAST(substr(o_orderpriority, 1, 1) AS SMALLINT) AS type"""

_cte("lines", (), "SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey")

_cte("mempool", ("lines",), f"""
SELECT l_shipdate + to_minutes(l_linenumber) AS event_date_time, {_ORDER_TX},
       CAST(length(o_orderpriority) * 10 AS BIGINT) AS size, o_custkey AS call_data_size,
       'sentry-' || CAST(l_suppkey AS VARCHAR) AS meta_client_name,
       g.r_name AS meta_client_geo_continent_code,
       CASE WHEN l_suppkey % 10 = 0 THEN 'holesky' ELSE 'mainnet' END AS meta_network_name
FROM lines
LEFT JOIN (SELECT s_suppkey, r_name FROM supplier
           JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) g
       ON l_suppkey = g.s_suppkey
""")

_cte("block_native", ("lines",), f"""
SELECT l_shipdate + to_hours(l_linenumber) AS detecttime,
       {root("'tx' || CAST(o_orderkey AS VARCHAR)")} AS hash,
       l_returnflag AS status, l_linestatus AS region,
       CASE WHEN l_linenumber > 5 THEN 'replaced' END AS "replace",
       CASE WHEN l_returnflag = 'A' THEN 'depth-' || CAST(l_linenumber AS VARCHAR) END AS reorg,
       CASE WHEN l_returnflag = 'R' THEN 'reverted-' || CAST(l_linenumber AS VARCHAR) END
         AS failurereason,
       CAST(l_linenumber AS DECIMAL(20, 0)) AS blockspending,
       CAST(l_linenumber * 1000 AS DECIMAL(20, 0)) AS timepending,
       CAST(o_orderkey AS DECIMAL(20, 0)) AS nonce,
       CAST(21000 + length(o_orderpriority) * 1000 AS DECIMAL(20, 0)) AS gas,
       CAST(round(o_totalprice) AS DECIMAL(38, 0)) AS gasprice,
       CAST(round(o_totalprice * 100) AS DECIMAL(38, 0)) AS value,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE {address("t", "o_orderkey")} END AS toaddress,
       {address("f", "o_custkey")} AS fromaddress,
       o_custkey AS datasize,
       CASE WHEN o_orderstatus <> 'F' THEN '0x' || substr(md5(o_orderpriority), 1, 8) END
         AS data4bytes,
       CASE WHEN l_suppkey % 10 = 0 THEN 'goerli' ELSE 'main' END AS network,
       CAST(substr(o_orderpriority, 1, 1) AS SMALLINT) AS type,
       CAST(round(l_tax * 100) AS DECIMAL(38, 0)) AS maxpriorityfeepergas,
       CAST(round(l_discount * 1000) AS DECIMAL(38, 0)) AS maxfeepergas,
       CAST(round(l_extendedprice) AS DECIMAL(38, 0)) AS basefeepergas,
       CASE WHEN l_linestatus = 'O' THEN 'timeout' END AS dropreason,
       CAST(NULL AS VARCHAR) AS rejectionreason,
       CAST(round(l_quantity) AS DECIMAL(20, 0)) AS gasused
FROM lines
""")

_cte("dumpster", ("lines",), f"""
SELECT o_orderdate + to_milliseconds(o_custkey * 7) AS "timestamp",
       {root("'tx' || CAST(o_orderkey AS VARCHAR)")} AS hash,
       CAST(CASE WHEN o_orderstatus = 'P' THEN 5 ELSE 1 END AS BIGINT) AS chain_id,
       {address("f", "o_custkey")} AS "from",
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE {address("t", "o_orderkey")} END AS "to",
       CAST(round(o_totalprice * 100) AS DECIMAL(38, 0)) AS value,
       CAST(o_orderkey AS DECIMAL(20, 0)) AS nonce,
       CAST(21000 + length(o_orderpriority) * 1000 AS DECIMAL(20, 0)) AS gas,
       CAST(round(o_totalprice) AS DECIMAL(38, 0)) AS gas_price,
       CAST(round(o_totalprice / 10) AS DECIMAL(38, 0)) AS gas_tip_cap,
       CASE WHEN o_orderstatus = 'F' THEN CAST(round(o_totalprice * 2) AS DECIMAL(38, 0)) END
         AS gas_fee_cap,
       CAST(length(o_orderpriority) * 100 AS BIGINT) AS data_size,
       '0x' || substr(md5(o_orderpriority), 1, 8) AS data_4bytes,
       string_split(o_orderpriority, '-') AS sources,
       CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderkey AS DECIMAL(20, 0)) END
         AS included_at_block_height,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_milliseconds(o_custkey * 7 + 12500) END
         AS included_block_timestamp,
       CASE WHEN o_orderstatus <> 'O' THEN CAST(12500 AS BIGINT) END AS inclusion_delay_ms
FROM lines
""")

_cte("canonical_tx", (), f"""
SELECT o_orderdate + to_days(d) AS updated_date_time, slot,
       make_timestamp(slot * 12000000) AS slot_start_date_time, slot // 32 AS epoch,
       make_timestamp((slot // 32) * 384000000) AS epoch_start_date_time,
       {root("'blk' || CAST(slot AS VARCHAR)")} AS block_root, 'deneb' AS block_version,
       o_custkey AS position, {_ORDER_TX},
       CAST(length(o_orderpriority) * 10 AS BIGINT) AS size, o_custkey AS call_data_size,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'sepolia' ELSE 'mainnet' END AS meta_network_name
FROM (SELECT *, epoch_us(o_orderdate) // 12000000 AS slot FROM orders),
     (VALUES (0), (1)) v(d)
""")

_cte("slot_partials", ("base",), """
SELECT slot, slot_start_date_time, event_type AS meta_client_name, meta_network_name,
       count(*) FILTER (WHERE event_type = 'purchase') AS blocks, count(*) AS attestations
FROM base
GROUP BY slot, slot_start_date_time, epoch, epoch_start_date_time, event_type,
         meta_network_name, hour(ts)
""")


def with_ctes(body: str, *names: str) -> str:
    """``WITH`` every CTE ``names`` needs (dependencies first), then ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({CTES[n][1].strip()})" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
