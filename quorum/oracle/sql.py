"""DuckDB SQL, one statement per registered query, over the driver's views.

Written independently of the Spark plans: brute-force where that is the plainest
statement of the meaning (the nearest join pairs every member with every proposal of its
key and ranks them; unanimity is a correlated EXISTS), so a shared mistake is unlikely.
"""

from __future__ import annotations

from quorum.oracle.adapters import RUN_TS, key, list_set_str, set_str, with_ctes

CLIENTS = ("prysm", "teku", "lodestar", "lighthouse", "nimbus")

Q: dict[str, str] = {}

# ---- M4 -----------------------------------------------------------------------------------
_M4_BODY = f"""
, seen AS (
  SELECT slot, slot_start_date_time, meta_network_name,
         count(DISTINCT attesting_validator_index) AS attesting_validators
  FROM att_w GROUP BY slot, slot_start_date_time, meta_network_name),
expected AS (
  SELECT slot, slot_start_date_time, meta_network_name, CAST(sum(sz) AS BIGINT) AS total_validators
  FROM (SELECT slot, slot_start_date_time, meta_network_name, committee_index,
               max(len(validators)) AS sz
        FROM committee_w GROUP BY ALL)
  GROUP BY slot, slot_start_date_time, meta_network_name)
SELECT s.slot, s.slot_start_date_time AS slot_started_at, s.meta_network_name AS network,
       s.attesting_validators, e.total_validators,
       CAST(s.attesting_validators AS DOUBLE) / CAST(e.total_validators AS DOUBLE)
         AS participation_rate,
       {key("s.slot", "s.meta_network_name")} AS unique_key, UPDATED AS updated_at
FROM seen s JOIN expected e
  ON s.slot = e.slot AND s.slot_start_date_time = e.slot_start_date_time
 AND s.meta_network_name = e.meta_network_name
"""


def _m4(where: str = "TRUE", updated: str = RUN_TS, drop_updated: bool = False) -> str:
    body = _M4_BODY.replace("UPDATED", updated)
    if drop_updated:
        body = body.replace(f", {updated} AS updated_at", "")
    pre = (f", att_w AS (SELECT * FROM att WHERE {where})"
           f", committee_w AS (SELECT * FROM committee WHERE {where})")
    sql = with_ctes("SELECT 1", "att", "committee")
    return sql[: -len("SELECT 1")] .rstrip() + "\n" + pre + body


Q["participation_rate"] = _m4()

# ---- M3 -----------------------------------------------------------------------------------
def _divergence(same_group: bool) -> str:
    if same_group:
        ok = "p.maxcnt = p.totalcnt"
    else:
        ok = ("EXISTS (SELECT 1 FROM per_client t WHERE t.slot = p.slot "
              "AND t.committee_index = p.committee_index AND t.client = p.client "
              "AND t.totalcnt = p.maxcnt)")
    flags = ",\n       ".join(
        f"CAST(max(CASE WHEN client = '{c}' AND ok THEN 1 ELSE 0 END) AS INTEGER) AS {c}_all_equal"
        for c in CLIENTS)
    every = " AND ".join(f"{c}_all_equal = 1" for c in CLIENTS)
    body = f"""
, counts AS (
  SELECT slot_start_date_time, slot, epoch, committee_index, meta_network_name,
         meta_consensus_implementation AS client, count(*) AS cnt
  FROM attd
  GROUP BY slot_start_date_time, slot, epoch, committee_index, meta_network_name,
           meta_consensus_implementation, beacon_block_root, source_epoch, source_root,
           target_epoch, target_root),
per_client AS (
  SELECT slot_start_date_time, slot, epoch, committee_index, meta_network_name, client,
         max(cnt) AS maxcnt, sum(cnt) AS totalcnt
  FROM counts GROUP BY ALL),
judged AS (SELECT p.*, {ok} AS ok FROM per_client p),
flags AS (
  SELECT slot_start_date_time, slot, epoch, committee_index, meta_network_name,
       {flags}
  FROM judged GROUP BY slot_start_date_time, slot, epoch, committee_index, meta_network_name)
SELECT slot_start_date_time AS slot_started_at, slot, epoch, committee_index,
       meta_network_name AS network,
       {key("slot_start_date_time", "slot", "committee_index", "meta_network_name")} AS unique_key,
       {RUN_TS} AS updated_at,
       CAST(CASE WHEN {every} THEN 1 ELSE 0 END AS INTEGER) AS all_equal,
       {", ".join(f"{c}_all_equal" for c in CLIENTS)}
FROM flags
"""
    sql = with_ctes("SELECT 1", "attd")
    return sql[: -len("SELECT 1")].rstrip() + "\n" + body


Q["divergence"] = _divergence(False)
Q["divergence_by_network"] = _divergence(True)

# ---- J5 / M5 / M6 -------------------------------------------------------------------------
def _nearest_body(members: str) -> str:
    """Brute force: every member paired with every proposal of its (validator, network),
    ranked by |distance| then earlier slot."""
    return f"""
, ranked AS (
  SELECT m.slot, m.slot_start_date_time, m.meta_network_name, m.validator_index,
         c.best_guess_single, abs(c.slot - m.slot) AS distance,
         row_number() OVER (PARTITION BY m.slot, m.slot_start_date_time, m.meta_network_name,
                                         m.validator_index
                            ORDER BY abs(c.slot - m.slot), c.slot) AS rn
  FROM {members} m
  LEFT JOIN cls c ON c.proposer_index = m.validator_index
                 AND c.meta_network_name = m.meta_network_name),
nearest AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1)
"""


def _by_guess() -> str:
    return f"""
SELECT slot, slot_start_date_time AS slot_started_at, meta_network_name AS network, guess,
       count(*) AS occurrences, {key("slot", "meta_network_name", "guess")} AS unique_key,
       {RUN_TS} AS updated_at
FROM (SELECT *, coalesce(CASE WHEN best_guess_single = '' THEN 'unknown'
                              ELSE best_guess_single END, 'unknown') AS guess FROM nearest)
GROUP BY slot, slot_start_date_time, meta_network_name, guess
"""


def _prefix(*names: str) -> str:
    sql = with_ctes("SELECT 1", *names)
    return sql[: -len("SELECT 1")].rstrip()


_MEMBERS = """
, members AS (SELECT DISTINCT slot, slot_start_date_time, meta_network_name,
                     attesting_validator_index AS validator_index FROM att)"""

Q["members_by_nearest_class"] = (_prefix("att", "cls") + _MEMBERS + _nearest_body("members")
                                 + _by_guess())
Q["nearest_join"] = (_prefix("att", "cls") + _MEMBERS + _nearest_body("members") + """
SELECT slot, slot_start_date_time, meta_network_name, validator_index, best_guess_single,
       distance FROM nearest""")
Q["nearest_join_ordered"] = Q["nearest_join"]
Q["missing_members_by_class"] = _prefix("att", "committee", "cls") + """
, expected AS (
  SELECT DISTINCT slot, slot_start_date_time, meta_network_name, validator_index
  FROM (SELECT slot, slot_start_date_time, meta_network_name,
               unnest(validators) AS validator_index
        FROM committee WHERE meta_network_name = 'mainnet')),
seen AS (SELECT DISTINCT slot, meta_network_name, attesting_validator_index AS validator_index
         FROM att WHERE meta_network_name = 'mainnet'),
missing AS (
  SELECT e.* FROM expected e
  WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.slot = e.slot
                    AND s.validator_index = e.validator_index
                    AND s.meta_network_name = e.meta_network_name))""" + _nearest_body("missing") + _by_guess()

# ---- M7 -----------------------------------------------------------------------------------
Q["first_reporter"] = _prefix("att") + f"""
, ranked AS (
  SELECT *, row_number() OVER (
           PARTITION BY slot_start_date_time, attesting_validator_index
           ORDER BY propagation_slot_start_diff, meta_network_name, meta_client_geo_country,
                    meta_client_geo_continent_code, slot) AS rn
  FROM att
  WHERE attesting_validator_index IS NOT NULL AND meta_consensus_implementation = 'teku')
SELECT slot, slot_start_date_time AS slot_started_at, meta_network_name AS network,
       attesting_validator_index AS validator_index,
       meta_client_geo_country AS nearest_client_country,
       meta_client_geo_continent_code AS nearest_client_continent_code,
       {key("slot", "attesting_validator_index", "meta_network_name")} AS unique_key,
       {RUN_TS} AS updated_at
FROM ranked WHERE rn = 1
"""

# ---- M8 - M12 -----------------------------------------------------------------------------
Q["tx_sightings"] = with_ctes(f"""
SELECT hash, {RUN_TS} AS updated_at, meta_network_name AS network, "from", "to", nonce,
       gas_price, gas, value, type, size, call_data_size,
       count(DISTINCT meta_client_name) AS total_seen_by_sentries,
       {set_str("meta_client_geo_continent_code")} AS seen_continents,
       min(event_date_time) AS first_seen_at
FROM mempool WHERE meta_network_name = 'mainnet'
GROUP BY hash, meta_network_name, "from", "to", nonce, gas_price, gas, value, type, size,
         call_data_size
""", "mempool")

Q["tx_lifecycle"] = with_ctes(f"""
SELECT hash, {RUN_TS} AS updated_at, nonce, gas, gasprice AS gas_price, value,
       toaddress AS "to", fromaddress AS "from", datasize AS call_data_size,
       data4bytes AS call_data_4_bytes, type,
       {set_str("status")} AS statuses,
       min("replace") AS "replace", min(reorg) AS reorg, min(blockspending) AS blocks_pending,
       min(maxpriorityfeepergas) AS max_priority_fee_per_gas,
       min(maxfeepergas) AS max_fee_per_gas,
       {set_str("basefeepergas")} AS base_fee_per_gas,
       min(gasused) AS gas_used,
       {set_str("failurereason")} AS failure_reasons,
       {set_str("dropreason")} AS drop_reasons,
       {set_str("rejectionreason")} AS rejection_reasons,
       {set_str("region")} AS seen_regions,
       min(detecttime) AS first_detected_at, min(timepending) AS first_time_pending_at,
       'mainnet' AS network
FROM block_native WHERE network = 'main'
GROUP BY hash, nonce, gas, gasprice, value, toaddress, fromaddress, datasize, data4bytes, type
""", "block_native")

Q["tx_distinct_external"] = with_ctes(f"""
SELECT hash, {RUN_TS} AS updated_at, "from", "to", value, nonce, gas, gas_price, gas_tip_cap,
       gas_fee_cap, data_size, data_4bytes, array_to_string(sources, ',') AS sources,
       included_at_block_height, included_block_timestamp, inclusion_delay_ms,
       'mainnet' AS network
FROM (SELECT DISTINCT hash, "from", "to", value, nonce, gas, gas_price, gas_tip_cap,
             gas_fee_cap, data_size, data_4bytes, sources, included_at_block_height,
             date_trunc('second', included_block_timestamp) AS included_block_timestamp,
             inclusion_delay_ms
      FROM dumpster WHERE chain_id = 1)
""", "dumpster")

Q["tx_distinct_canonical"] = with_ctes(f"""
SELECT hash, {RUN_TS} AS updated_at, network, slot, slot_started_at, epoch, epoch_start_at,
       block_root, block_version, position, "from", "to", nonce, gas_price, gas, value, type,
       size, call_data_size
FROM (SELECT DISTINCT hash, meta_network_name AS network, slot,
             slot_start_date_time AS slot_started_at, epoch,
             epoch_start_date_time AS epoch_start_at, block_root, block_version, position,
             "from", "to", nonce, gas_price, gas, value, type, size, call_data_size
      FROM canonical_tx WHERE meta_network_name = 'mainnet')
""", "canonical_tx")

Q["tx_hash_universe"] = with_ctes(f"""
SELECT {RUN_TS} AS updated_at, 'mainnet' AS network, hash
FROM (SELECT hash FROM mempool WHERE meta_network_name = 'mainnet'
      UNION SELECT hash FROM block_native WHERE network = 'main'
      UNION SELECT hash FROM dumpster WHERE chain_id = 1
      UNION SELECT hash FROM canonical_tx WHERE meta_network_name = 'mainnet')
""", "mempool", "block_native", "dumpster", "canonical_tx")

# ---- M1 -----------------------------------------------------------------------------------
Q["reconcile_blocks"] = _prefix("event_block", "gossip_block_final", "canonical_block_final") + f"""
, e AS (SELECT CAST(slot AS INTEGER) AS slot, CAST(epoch AS INTEGER) AS epoch,
               meta_network_name AS network, block AS root,
               min(slot_start_date_time) AS st, count(*) AS cnt
        FROM event_block GROUP BY 1, 2, 3, 4),
g AS (SELECT CAST(slot AS INTEGER) AS slot, CAST(epoch AS INTEGER) AS epoch,
             meta_network_name AS network, block AS root,
             min(slot_start_date_time) AS st, count(*) AS cnt
      FROM gossip_block_final GROUP BY 1, 2, 3, 4),
c AS (SELECT CAST(slot AS INTEGER) AS slot, CAST(epoch AS INTEGER) AS epoch,
             meta_network_name AS network, block_root AS root, min(slot_start_date_time) AS st
      FROM canonical_block_final GROUP BY 1, 2, 3, 4),
eg AS (SELECT coalesce(e.slot, g.slot) AS slot, coalesce(e.epoch, g.epoch) AS epoch,
              coalesce(e.network, g.network) AS network,
              e.root AS e_root, e.st AS e_st, e.cnt AS e_cnt,
              g.root AS g_root, g.st AS g_st, g.cnt AS g_cnt
       FROM e FULL JOIN g ON e.slot = g.slot AND e.epoch = g.epoch AND e.network = g.network),
comb AS (SELECT coalesce(eg.slot, c.slot) AS slot, coalesce(eg.epoch, c.epoch) AS epoch,
                coalesce(eg.network, c.network) AS network,
                coalesce(eg.e_st, eg.g_st, c.st) AS slot_started_at,
                eg.e_root, eg.g_root, c.root AS c_root, eg.e_cnt, eg.g_cnt
         FROM eg FULL JOIN c ON eg.slot = c.slot AND eg.epoch = c.epoch
                            AND eg.network = c.network),
agg AS (SELECT slot, slot_started_at, epoch, network, max(c_root) AS canon,
               list(e_root) AS es, list(g_root) AS gs,
               CAST(coalesce(max(e_cnt), 0) AS BIGINT) AS e_cnt,
               CAST(coalesce(max(g_cnt), 0) AS BIGINT) AS g_cnt
        FROM comb GROUP BY slot, slot_started_at, epoch, network)
SELECT {RUN_TS} AS updated_at, slot, slot_started_at, epoch, network,
       canon AS canonical_beacon_block_root_hash,
       {list_set_str("list_filter(es, lambda x: x IS NOT NULL AND (canon IS NULL OR x <> canon))")}
         AS non_canonical_beacon_api_event_stream_block_root_hashes,
       {list_set_str("list_filter(gs, lambda x: x IS NOT NULL AND (canon IS NULL OR x <> canon))")}
         AS non_canonical_gossipsub_block_root_hashes,
       e_cnt AS total_seen_beacon_api_event_stream, g_cnt AS total_seen_gossipsub
FROM agg
"""

# ---- M2 -----------------------------------------------------------------------------------
Q["reconcile_blob_counts"] = _prefix("event_blob", "canonical_blob_final", "gossip_blob_final",
                                     "api_block", "canonical_block_final") + f"""
, e AS (SELECT CAST(slot AS INTEGER) AS slot, CAST(epoch AS INTEGER) AS epoch,
               meta_network_name AS network, block_root AS root,
               min(slot_start_date_time) AS st, CAST(max(blob_index) + 1 AS BIGINT) AS cnt
        FROM event_blob GROUP BY 1, 2, 3, 4),
c AS (SELECT CAST(slot AS INTEGER) AS slot, CAST(epoch AS INTEGER) AS epoch,
             meta_network_name AS network, block_root AS root,
             min(slot_start_date_time) AS st, CAST(max(blob_index) + 1 AS BIGINT) AS cnt
      FROM canonical_blob_final GROUP BY 1, 2, 3, 4),
root_map AS (
  SELECT DISTINCT CAST(slot AS INTEGER) AS slot, block_root, meta_network_name AS network, state_root
  FROM api_block
  UNION ALL
  SELECT DISTINCT CAST(slot AS INTEGER), block_root, meta_network_name, state_root
  FROM canonical_block_final),
gs AS (SELECT CAST(slot AS INTEGER) AS slot, CAST(epoch AS INTEGER) AS epoch,
              meta_network_name AS network, state_root,
              min(slot_start_date_time) AS st, CAST(max(blob_index) + 1 AS BIGINT) AS cnt
       FROM gossip_blob_final GROUP BY 1, 2, 3, 4),
g AS (SELECT gs.slot, gs.epoch, gs.network, gs.st, gs.cnt, m.block_root AS root
      FROM gs LEFT JOIN root_map m
        ON gs.slot = m.slot AND gs.state_root = m.state_root AND gs.network = m.network),
eg AS (SELECT coalesce(e.slot, g.slot) AS slot, coalesce(e.epoch, g.epoch) AS epoch,
              coalesce(e.network, g.network) AS network,
              e.root AS e_root, e.st AS e_st, e.cnt AS e_cnt,
              g.root AS g_root, g.st AS g_st, g.cnt AS g_cnt
       FROM e FULL JOIN g ON e.slot = g.slot AND e.epoch = g.epoch AND e.network = g.network),
comb AS (SELECT coalesce(eg.slot, c.slot) AS slot, coalesce(eg.epoch, c.epoch) AS epoch,
                coalesce(eg.network, c.network) AS network,
                coalesce(c.st, eg.e_st, eg.g_st) AS slot_started_at,
                coalesce(c.root, eg.e_root, eg.g_root) AS beacon_block_root_hash,
                coalesce(c.cnt, eg.e_cnt, eg.g_cnt) AS blob_count
         FROM eg FULL JOIN c ON eg.slot = c.slot AND eg.epoch = c.epoch
                            AND eg.network = c.network)
SELECT {RUN_TS} AS updated_at, slot, slot_started_at, epoch, network, beacon_block_root_hash,
       CAST(max(blob_count) AS BIGINT) AS blob_count
FROM comb WHERE beacon_block_root_hash IS NOT NULL
GROUP BY slot, slot_started_at, epoch, network, beacon_block_root_hash
"""

# ---- S3 / S4 / S5 / S2 --------------------------------------------------------------------
Q["latest_by_key"] = """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
"""

Q["compact_replacing"] = _m4(updated="CASE WHEN s.slot_start_date_time >= TIMESTAMP '2024-01-15 00:00:00' "
                                     "THEN TIMESTAMP '2024-02-02 00:00:00' "
                                     "ELSE TIMESTAMP '2024-02-01 00:00:00' END")

Q["window_scan"] = """
SELECT event_id, ts, user_id, event_type FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' - INTERVAL 1 DAY
             AND TIMESTAMP '2024-01-20 00:00:00'
"""

# ---- S6 / S7 ------------------------------------------------------------------------------
_RUN_META = """
WITH models AS (SELECT DISTINCT event_type || '/' || CAST(user_id AS VARCHAR) AS model FROM events),
meta AS (SELECT event_type || '/' || CAST(user_id AS VARCHAR) AS model,
                max(date_trunc('second', ts)) AS last_run
         FROM events WHERE event_type <> 'signup' GROUP BY 1),
w AS (SELECT m.model, t.last_run FROM models m LEFT JOIN meta t ON m.model = t.model)
"""
_NOW = "TIMESTAMP '2024-01-31 00:00:00'"

Q["run_window"] = _RUN_META + f"""
SELECT model,
       CASE WHEN last_run IS NULL THEN {_NOW} - INTERVAL 1 MONTH ELSE last_run END AS start_time,
       CASE WHEN last_run IS NULL THEN {_NOW}
            ELSE least(last_run + INTERVAL 1 HOUR, {_NOW}) END AS end_time,
       CASE WHEN last_run IS NULL THEN {_NOW}
            ELSE least(last_run + INTERVAL 1 MONTH, {_NOW}) END AS next_last_run
FROM w
"""

Q["run_commit"] = _RUN_META + f"""
SELECT model, {_NOW} AS updated_date_time,
       CASE WHEN last_run IS NULL THEN {_NOW}
            ELSE least(last_run + INTERVAL 1 MONTH, {_NOW}) END AS last_run_date_time
FROM w
"""

# ---- A8 / F9 / F10 / S9 / K / T4 ----------------------------------------------------------
Q["top_variant"] = _prefix("attd") + """
, counts AS (
  SELECT slot_start_date_time, slot, epoch, committee_index, meta_network_name,
         meta_consensus_implementation, beacon_block_root, source_epoch, source_root,
         target_epoch, target_root, count(*) AS cnt
  FROM attd GROUP BY ALL)
SELECT slot_start_date_time, slot, epoch, committee_index, meta_network_name,
       meta_consensus_implementation, beacon_block_root, source_epoch, source_root,
       target_epoch, target_root, cnt AS maxcnt
FROM counts
QUALIFY row_number() OVER (
  PARTITION BY slot_start_date_time, slot, epoch, committee_index, meta_network_name,
               meta_consensus_implementation
  ORDER BY cnt DESC, beacon_block_root DESC, source_epoch DESC, source_root DESC,
           target_epoch DESC, target_root DESC) = 1
"""

Q["explode_members"] = _prefix("committee") + """
SELECT slot, slot_start_date_time, meta_network_name, committee_index, meta_client_name,
       unnest(validators) AS validator_index
FROM committee
"""

Q["other_roots"] = _prefix("event_block", "canonical_block_final") + f"""
, seen AS (SELECT slot, epoch, meta_network_name, list(DISTINCT block) AS roots
           FROM event_block GROUP BY ALL),
canon AS (SELECT slot, epoch, meta_network_name, max(block_root) AS canonical
          FROM canonical_block_final GROUP BY ALL)
SELECT s.slot, s.epoch, s.meta_network_name, c.canonical,
       {list_set_str("list_filter(s.roots, lambda x: x IS NOT NULL AND (c.canonical IS NULL OR x <> c.canonical))")}
         AS other_roots
FROM seen s LEFT JOIN canon c
  ON s.slot = c.slot AND s.epoch = c.epoch AND s.meta_network_name = c.meta_network_name
"""

Q["merge_partial_sums"] = _prefix("slot_partials") + """
SELECT slot, slot_start_date_time, meta_client_name, meta_network_name,
       CAST(sum(blocks) AS BIGINT) AS blocks, CAST(sum(attestations) AS BIGINT) AS attestations
FROM slot_partials GROUP BY ALL
"""

Q["surrogate_key"] = _prefix("att") + f"""
SELECT slot, validator_index, network,
       {key("slot", "validator_index", "network")} AS unique_key,
       CAST(slot AS VARCHAR) || CAST(validator_index AS VARCHAR) || network AS naive_key
FROM (SELECT DISTINCT slot, attesting_validator_index AS validator_index,
             meta_network_name AS network FROM att)
"""

Q["slot_tumbling"] = _prefix("base") + """
SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end,
       meta_network_name, count(*) AS events
FROM base GROUP BY ALL
"""

# ---- T1 - T3 ------------------------------------------------------------------------------
Q["incremental_replay"] = _m4(drop_updated=True)
Q["stream_participation"] = _m4(drop_updated=True)
Q["catch_up_replay"] = _m4(drop_updated=True)
Q["compacted_read"] = _m4(drop_updated=True)
Q["bucketed_participation"] = Q["participation_rate"]

Q["sorted_append"] = """
SELECT CAST(ts AS DATE) AS day, count(*) AS events, CAST(0 AS BIGINT) AS descents FROM events GROUP BY ALL
"""

Q["display_times"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown, date_trunc('second', ts) AS parsed,
       CAST(NULL AS TIMESTAMP) AS unparsable
FROM events
"""

Q["outer_chain"] = _prefix("event_block", "gossip_block_final", "canonical_block_final") + """
, e AS (SELECT slot, epoch, meta_network_name AS network, count(*) AS event_stream_seen
        FROM event_block GROUP BY ALL),
g AS (SELECT slot, epoch, meta_network_name AS network, count(*) AS gossip_seen
      FROM gossip_block_final GROUP BY ALL),
c AS (SELECT slot, epoch, meta_network_name AS network, count(DISTINCT block_root) AS canonical_roots
      FROM canonical_block_final GROUP BY ALL)
SELECT coalesce(eg.slot, c.slot) AS slot, coalesce(eg.epoch, c.epoch) AS epoch,
       coalesce(eg.network, c.network) AS network, eg.event_stream_seen, eg.gossip_seen,
       c.canonical_roots
FROM (SELECT coalesce(e.slot, g.slot) AS slot, coalesce(e.epoch, g.epoch) AS epoch,
             coalesce(e.network, g.network) AS network, e.event_stream_seen, g.gossip_seen
      FROM e FULL JOIN g ON e.slot = g.slot AND e.epoch = g.epoch AND e.network = g.network) eg
FULL JOIN c ON eg.slot = c.slot AND eg.epoch = c.epoch AND eg.network = c.network
"""

def _checks(source: str, cte: str, cols: list[tuple[str, str, str]]) -> str:
    parts = []
    for col, rule, bad in cols:
        parts.append(f"SELECT '{col}' AS \"column\", '{rule}' AS rule, count(*) AS checked, "
                     f"CAST(count(*) FILTER (WHERE {bad}) AS BIGINT) AS violations, "
                     f"'{source}' AS source FROM {cte}")
    return "\nUNION ALL\n".join(parts)


def _hex(col: str, digits: int) -> str:
    return f"{col} IS NOT NULL AND NOT regexp_full_match({col}, '0x[0-9a-f]{{{digits}}}')"


def _neg(col: str) -> str:
    return f"{col} IS NOT NULL AND {col} < 0"


Q["source_checks"] = _prefix("mempool", "block_native", "dumpster") + "\n" + "\nUNION ALL\n".join([
    _checks("mempool_transaction", "mempool", [
        ("hash", "hash_hex_64", _hex("hash", 64)),
        ("from", "address_hex_40", _hex('"from"', 40)),
        ("to", "address_hex_40", _hex('"to"', 40)),
        ("gas_price", "uint128_range", _neg("gas_price")),
        ("value", "uint128_range", _neg("value"))]),
    _checks("block_native_mempool_transaction", "block_native", [
        ("hash", "hash_hex_64", _hex("hash", 64)),
        ("gasprice", "uint128_range", _neg("gasprice")),
        ("value", "uint128_range", _neg("value")),
        ("toaddress", "address_hex_40", _hex("toaddress", 40)),
        ("fromaddress", "address_hex_40", _hex("fromaddress", 40)),
        ("data4bytes", "selector_hex_8", _hex("data4bytes", 8)),
        ("maxpriorityfeepergas", "uint128_range", _neg("maxpriorityfeepergas")),
        ("maxfeepergas", "uint128_range", _neg("maxfeepergas")),
        ("basefeepergas", "uint128_range", _neg("basefeepergas"))]),
    _checks("mempool_dumpster_transaction", "dumpster", [
        ("hash", "hash_hex_64", _hex("hash", 64)),
        ("from", "address_hex_40", _hex('"from"', 40)),
        ("to", "address_hex_40", _hex('"to"', 40)),
        ("value", "uint128_range", _neg("value")),
        ("gas_price", "uint128_range", _neg("gas_price")),
        ("gas_tip_cap", "uint128_range", _neg("gas_tip_cap")),
        ("gas_fee_cap", "uint128_range", _neg("gas_fee_cap")),
        ("data_4bytes", "selector_hex_8", _hex("data_4bytes", 8))]),
])

Q["tx_sightings_merged"] = with_ctes(f"""
SELECT hash, {RUN_TS} AS updated_at, meta_network_name AS network, "from", "to", nonce,
       gas_price, gas, value, type, size, call_data_size,
       count(DISTINCT meta_client_name) AS total_seen_by_sentries,
       {set_str("meta_client_geo_continent_code")} AS seen_continents,
       min(event_date_time) AS first_seen_at
FROM mempool
WHERE meta_network_name = 'mainnet'
  AND hash IN (SELECT hash FROM mempool WHERE meta_network_name = 'mainnet'
               AND event_date_time BETWEEN TIMESTAMP '1997-01-01 00:00:00'
                                       AND TIMESTAMP '1997-12-31 23:59:59')
GROUP BY hash, meta_network_name, "from", "to", nonce, gas_price, gas, value, type, size,
         call_data_size
""", "mempool")

Q["stream_first_reporter"] = Q["first_reporter"].replace(f",\n       {RUN_TS} AS updated_at", "")

Q["stream_first_reporter_state"] = Q["late_first_reporter"] = Q["stream_first_reporter"]
Q["stream_hash_universe"] = Q["tx_hash_universe"]

Q["tx_lifecycle_merged"] = Q["tx_lifecycle"].replace(
    "FROM block_native WHERE network = 'main'",
    "FROM block_native WHERE network = 'main'\n"
    "  AND hash IN (SELECT hash FROM block_native WHERE network = 'main'\n"
    "               AND detecttime BETWEEN TIMESTAMP '1997-01-01 00:00:00'\n"
    "                                  AND TIMESTAMP '1997-12-31 23:59:59')")
assert Q["tx_lifecycle_merged"] != Q["tx_lifecycle"]

ORACLE_SQL = dict(Q)
