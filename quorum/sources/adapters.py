"""Fixture adapters: shape the driver's generic tables like the telemetry sources.

The driver ships TPC-H-like tables plus an ``events`` stream, not beacon-chain telemetry,
so every job is exercised on sources *derived* from them.  Each adapter is a pure
DataFrame transformation of whole driver tables (no sampling, no row caps); the rules
below decide which source a row lands in and synthesise the attributes the jobs read.
The same rules are written a second time, independently, as DuckDB SQL in
``quorum.oracle.adapters``.

Fixed rules (must agree with the SQL oracle):

* adapter slot = 6 hours of ``events.ts`` (microseconds since 1970 div 21,600,000,000);
  slot start = slot x 6 h; epoch = slot div 4 (one day); epoch start = epoch x 24 h.
* network: 'holesky' when event_id % 4 = 0, else 'mainnet'.
* consensus client by event type: click -> prysm, view -> teku, error -> lodestar,
  purchase -> lighthouse, signup -> nimbus.
* root of key k: '0x' || md5(k || 'a') || md5(k || 'b'); block root variant of an event
  'B' when event_id % 11 = 0 else 'A'; key = slot || '/' || variant.
  state root of a block root r: '0x' || md5('s' || r) || md5('t' || r).
* attestation: member = user_id (NULL when event_id % 13 = 0); committee =
  string(user_id div 32); delay = ms since slot start; geo = customer user_id's nation
  and region.
* committee: per (epoch, network, committee) the sorted distinct users seen in that epoch,
  published for every slot of the epoch by two sentries; the second one drops the
  smallest member (duplicate rows of different length, possibly empty).
* classification: events with event_id % 5 = 0; proposer = user_id; best guess =
  upper(client), '' for signup; version = event time.
* event block stream: click / view with slot % 6 <> 0.  gossip block: error / purchase with
  slot % 5 <> 0, root variant 'C' when event_id % 13 = 0 else 'A'.  canonical block:
  distinct (slot, network) with slot % 7 <> 0, root variant 'A', stored twice (versions
  updated at slot start + 1 day and + 2 days).
* blobs (purchase events): index = event_id % 6.  event side: slot % 6 <> 0 and even
  event_id; canonical side: slot % 7 <> 0, root 'A'; gossip side: event_id % 3 <> 0, keyed by
  state root; API block map: slot % 9 <> 0.
* transactions (orders / lineitem / supplier / nation / region): tx hash = root('tx' ||
  orderkey); sender = '0x' || first 40 hex of md5('f' || custkey); receiver NULL for status
  'P' else from md5('t' || orderkey); attributes from the order; sentry = supplier, its
  region = continent; network 'holesky' (block-native: 'goerli') when l_suppkey % 10 = 0.
  dumpster: one row per line item (the same tx in several dump files), chain 5 for status
  'P' else 1, time = order date + custkey x 7 ms.  canonical tx: orders with status 'F',
  12-second slots of the order date, network 'sepolia' for priority '5-LOW', stored
  twice (updated at order date and + 1 day).
* slot partial sums: per (slot, client = event type, network, hour of ts) blocks =
  purchases, attestations = rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quorum.sources.catalog import conform

EPOCH0 = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
SLOT_MICROS = 21_600_000_000
SLOTS_PER_EPOCH = 4
COMMITTEE_WIDTH = 32
TX_SLOT_SECONDS = 12

# Client implementation by event type.
CLIENT_BY_EVENT = {
    "click": "prysm",
    "view": "teku",
    "error": "lodestar",
    "purchase": "lighthouse",
    "signup": "nimbus",
}


def root_of(key: Column) -> Column:
    return F.concat(F.lit("0x"), F.md5(F.concat(key, F.lit("a"))),
                    F.md5(F.concat(key, F.lit("b"))))


def state_root_of(block_root: Column) -> Column:
    return F.concat(F.lit("0x"), F.md5(F.concat(F.lit("s"), block_root)),
                    F.md5(F.concat(F.lit("t"), block_root)))


def address_of(prefix: str, key: Column) -> Column:
    return F.concat(F.lit("0x"), F.substring(F.md5(F.concat(F.lit(prefix), key.cast("string"))), 1, 40))


def _block_key(variant: Column) -> Column:
    return F.concat(F.col("slot").cast("string"), F.lit("/"), variant)


def _client(event_type: Column) -> Column:
    expr = None
    for ev, client in CLIENT_BY_EVENT.items():
        expr = (F.when(event_type == ev, client) if expr is None
                else expr.when(event_type == ev, client))
    return expr


def slot_start(slot: str) -> Column:
    return F.expr(f"timestampadd(SECOND, {slot} * {SLOT_MICROS // 1_000_000}, {EPOCH0})")


def event_base(events: DataFrame) -> DataFrame:
    """Slot, epoch, network, client and root variant of every event row."""
    ev = events.withColumn(
        "slot", F.expr(f"timestampdiff(MICROSECOND, {EPOCH0}, ts) div {SLOT_MICROS}"))
    return ev.select(
        "event_id", "ts", "user_id", "event_type", "value", "slot",
        slot_start("slot").alias("slot_start_date_time"),
        F.expr(f"slot div {SLOTS_PER_EPOCH}").alias("epoch"),
        F.expr(f"timestampadd(SECOND, (slot div {SLOTS_PER_EPOCH}) * "
               f"{SLOTS_PER_EPOCH * SLOT_MICROS // 1_000_000}, {EPOCH0})")
         .alias("epoch_start_date_time"),
        F.when(F.col("event_id") % 4 == 0, "holesky").otherwise("mainnet")
         .alias("meta_network_name"),
        _client(F.col("event_type")).alias("meta_consensus_implementation"),
        F.when(F.col("event_id") % 11 == 0, "B").otherwise("A").alias("variant"),
    )


# inferred schemas of driver tables by path: later reads skip the footer-inference job
_SCHEMAS: dict[str, object] = {}


def _two_versions(df: DataFrame) -> DataFrame:
    """Two versions of every row of a replacing source: a first one with other values
    (``latest`` false), superseded a day later."""
    versions = F.array(F.struct(F.col("ts").alias("updated_date_time"), F.lit(False).alias("latest")),
                       F.struct((F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("updated_date_time"),
                                F.lit(True).alias("latest")))
    return df.select("*", F.inline(versions))


class Fixture:
    """Driver tables under ``sf_dir`` and every source derived from them (all lazy)."""

    def __init__(self, spark: SparkSession, sf_dir: str,
                 tables: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.tables = dict(tables or {})

    def table(self, name: str) -> DataFrame:
        if name in self.tables:
            return self.tables[name]
        path = f"{self.sf_dir}/{name}.parquet"
        schema = _SCHEMAS.get(path)
        df = (self.spark.read.schema(schema) if schema is not None else self.spark.read).parquet(path)
        _SCHEMAS.setdefault(path, StructType(list(df.schema.fields)))  # a copy: callers may extend theirs
        return df

    # ---- event-derived base ----------------------------------------------------------------
    @cached_property
    def base(self) -> DataFrame:
        return event_base(self.table("events"))

    # ---- attestations ---------------------------------------------------------------------
    def _vote_columns(self) -> list[Column]:
        return [
            root_of(_block_key(F.col("variant"))).alias("beacon_block_root"),
            (F.col("epoch") - 1).alias("source_epoch"),
            root_of(F.concat((F.col("epoch") - 1).cast("string"), F.lit("/S"))).alias("source_root"),
            F.col("epoch").alias("target_epoch"),
            root_of(F.concat(F.col("epoch").cast("string"), F.lit("/T"))).alias("target_root"),
        ]

    @cached_property
    def attestation(self) -> DataFrame:
        b = (self.base
             .join(self.table("customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey"),
                   "user_id", "left")
             .join(self.table("nation").select("n_nationkey", "n_regionkey",
                                               F.col("n_name").alias("meta_client_geo_country")),
                   F.col("c_nationkey") == F.col("n_nationkey"), "left")
             .join(self.table("region").select("r_regionkey",
                                               F.col("r_name").alias("meta_client_geo_continent_code")),
                   F.col("n_regionkey") == F.col("r_regionkey"), "left"))
        df = b.select(
            F.col("ts").alias("event_date_time"), "slot", "slot_start_date_time",
            F.expr(f"timestampdiff(MICROSECOND, slot_start_date_time, ts) div 1000")
             .alias("propagation_slot_start_diff"),
            F.expr(f"cast(user_id div {COMMITTEE_WIDTH} as string)").alias("committee_index"),
            F.when(F.col("event_id") % 13 == 0, F.lit(None).cast("bigint"))
             .otherwise(F.col("user_id")).alias("attesting_validator_index"),
            *self._vote_columns(), "epoch", "epoch_start_date_time",
            "meta_client_geo_country", "meta_client_geo_continent_code",
            "meta_network_name", "meta_consensus_implementation",
        )
        return conform(df, "beacon_api_eth_v1_events_attestation")

    @cached_property
    def attestation_data(self) -> DataFrame:
        df = self.base.select(
            F.col("ts").alias("event_date_time"), "slot", "slot_start_date_time", "epoch",
            "epoch_start_date_time",
            F.expr(f"cast(user_id div {COMMITTEE_WIDTH} as string)").alias("committee_index"),
            *self._vote_columns(), "meta_network_name", "meta_consensus_implementation",
        )
        return conform(df, "beacon_api_eth_v1_validator_attestation_data")

    @cached_property
    def committee(self) -> DataFrame:
        keys = ["epoch", "meta_network_name"]
        members = (self.base
                   .withColumn("committee_index",
                               F.expr(f"cast(user_id div {COMMITTEE_WIDTH} as string)"))
                   .groupBy(*keys, "committee_index")
                   .agg(F.array_sort(F.collect_set("user_id")).alias("validators")))
        slots = self.base.select("slot", "slot_start_date_time", "epoch_start_date_time",
                                 *keys).distinct()
        full = slots.join(members, keys)
        cols = ["slot", "slot_start_date_time", "epoch", "epoch_start_date_time",
                "committee_index", "meta_network_name"]
        # both sentries' rows from one pass over the join
        reports = F.array(
            F.struct(F.lit("sentry-1").alias("meta_client_name"), F.col("validators").alias("v")),
            F.struct(F.lit("sentry-2").alias("meta_client_name"),
                     F.expr("slice(validators, 2, size(validators) - 1)").alias("v")))
        df = full.select(*cols, F.inline(reports)).withColumnRenamed("v", "validators")
        return conform(df, "beacon_api_eth_v1_beacon_committee")

    @cached_property
    def classification(self) -> DataFrame:
        # every event classifies a block, one in five its own user's, the others a proposer
        # that no attesting member is (negative indexes), so nearest proposals stay sparse
        df = self.base.select(
            F.col("ts").alias("updated_date_time"), F.col("ts").alias("event_date_time"),
            "slot", "slot_start_date_time", "epoch", "epoch_start_date_time",
            F.when(F.col("event_type") == "signup", F.lit(""))
             .otherwise(F.upper("meta_consensus_implementation")).alias("best_guess_single"),
            F.when(F.col("event_id") % 5 == 0, F.col("user_id")).otherwise(-F.col("user_id") - 1)
             .alias("proposer_index"), "meta_network_name",
        )
        return conform(df, "beacon_block_classification")

    # ---- blocks ---------------------------------------------------------------------------
    def _block_events(self, observer: str) -> DataFrame:
        """The events that an observer of blocks reports.  Every event is some observer's:
        clicks and views are the event stream's and the others gossip's, except that one
        slot in six is seen by gossip alone and another by the event stream alone; and slots
        that are no multiple of seven are canonical, the others' events stay sightings."""
        stream = F.col("event_type").isin("click", "view")
        stream = F.when(F.col("slot") % 6 == 0, False).when(F.col("slot") % 6 == 3, True).otherwise(stream)
        return self.base.filter(stream if observer == "event_stream" else ~stream)

    @cached_property
    def event_block(self) -> DataFrame:
        df = (self._block_events("event_stream")
              .select(F.col("ts").alias("event_date_time"), "slot", "slot_start_date_time",
                      "epoch", "epoch_start_date_time",
                      root_of(_block_key(F.col("variant"))).alias("block"),
                      "meta_network_name"))
        return conform(df, "beacon_api_eth_v1_events_block")

    @cached_property
    def gossip_block(self) -> DataFrame:
        variant = F.when(F.col("event_id") % 13 == 0, "C").otherwise("A")
        df = (_two_versions(self._block_events("gossip"))
              .select(F.col("event_id").alias("unique_key"), "updated_date_time",
                      F.col("ts").alias("event_date_time"), "slot", "slot_start_date_time",
                      "epoch", "epoch_start_date_time",
                      F.when(F.col("latest"), root_of(_block_key(variant))).otherwise(root_of(_block_key(F.lit("D"))))
                       .alias("block"), "meta_network_name"))
        return conform(df, "libp2p_gossipsub_beacon_block")

    @cached_property
    def canonical_block(self) -> DataFrame:
        # a slot that is a multiple of seven has no canonical block: it is a missed slot
        slots = (self.base
                 .select("slot", "slot_start_date_time", "epoch", "epoch_start_date_time",
                         "meta_network_name").distinct().filter(F.col("slot") % 7 != 0))
        root = root_of(_block_key(F.lit("A")))
        versions = []
        for days, version in ((1, "deneb"), (2, "electra")):
            versions.append(slots.select(
                F.expr(f"slot_start_date_time + INTERVAL {days} DAY").alias("updated_date_time"),
                F.col("slot_start_date_time").alias("event_date_time"),
                "slot", "slot_start_date_time", "epoch", "epoch_start_date_time",
                root.alias("block_root"), F.lit(version).alias("block_version"),
                state_root_of(root).alias("state_root"), "meta_network_name"))
        return conform(versions[0].unionByName(versions[1]), "canonical_beacon_block")

    # ---- blobs ----------------------------------------------------------------------------
    def _blob_events(self, observer: str) -> DataFrame:
        """The events that an observer of blobs reports.  Purchases are dealt by slot so that
        each precedence case occurs; every event of another kind is a block of the API, so
        all events are read and none is without an observer."""
        purchase, rest = F.col("event_type") == "purchase", F.col("slot") % 6
        chosen = {
            "event_stream": purchase & rest.isin(0, 1, 4),
            "canonical": purchase & rest.isin(1, 2, 5),
            "gossip": purchase & rest.isin(2, 3, 4, 5),
            "api": ~purchase | ~rest.isin(3),
        }[observer]
        return self.base.filter(chosen)

    @cached_property
    def event_blob(self) -> DataFrame:
        df = (self._blob_events("event_stream")
              .select(F.col("ts").alias("event_date_time"), "slot", "slot_start_date_time",
                      "epoch", "epoch_start_date_time",
                      root_of(_block_key(F.col("variant"))).alias("block_root"),
                      (F.col("event_id") % 6).alias("blob_index"), "meta_network_name"))
        return conform(df, "beacon_api_eth_v1_events_blob_sidecar")

    @cached_property
    def canonical_blob(self) -> DataFrame:
        df = (_two_versions(self._blob_events("canonical"))
              .select(F.col("event_id").alias("unique_key"), "updated_date_time",
                      F.col("ts").alias("event_date_time"), "slot", "slot_start_date_time",
                      "epoch", "epoch_start_date_time",
                      root_of(_block_key(F.lit("A"))).alias("block_root"),
                      F.when(F.col("latest"), F.col("event_id") % 6).otherwise(F.lit(9)).alias("blob_index"),
                      "meta_network_name"))
        return conform(df, "canonical_beacon_blob_sidecar")

    @cached_property
    def gossip_blob(self) -> DataFrame:
        df = (_two_versions(self._blob_events("gossip"))
              .select(F.col("event_id").alias("unique_key"), "updated_date_time",
                      F.col("ts").alias("event_date_time"), "slot", "slot_start_date_time",
                      "epoch", "epoch_start_date_time",
                      state_root_of(root_of(_block_key(F.col("variant")))).alias("state_root"),
                      F.when(F.col("latest"), F.col("event_id") % 6).otherwise(F.lit(9)).alias("blob_index"),
                      "meta_network_name"))
        return conform(df, "libp2p_gossipsub_blob_sidecar")

    @cached_property
    def api_block(self) -> DataFrame:
        root = root_of(_block_key(F.col("variant")))
        df = (self._blob_events("api")
              .select(F.col("ts").alias("event_date_time"), "slot", "slot_start_date_time",
                      "epoch", "epoch_start_date_time", root.alias("block_root"),
                      state_root_of(root).alias("state_root"), "meta_network_name"))
        return conform(df, "beacon_api_eth_v2_beacon_block")

    # ---- transactions ---------------------------------------------------------------------
    def _dealt(self, name: str, key: str) -> DataFrame:
        """A table dealt by ``key`` to all shuffle partitions, however few bytes its rows are:
        without the number, partitions would be merged by these bytes, and the attributes that
        are derived after it make a merged partition many times as large."""
        return self.table(name).repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), key)

    @cached_property
    def _orders_tx(self) -> DataFrame:
        """Orders with their transaction attributes, derived once per order (before any
        join with line items, so each digest is computed once per order)."""
        o = self._dealt("orders", "o_orderkey")
        return o.select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
            "o_orderpriority",
            root_of(F.concat(F.lit("tx"), F.col("o_orderkey").cast("string"))).alias("tx_hash"),
            address_of("f", F.col("o_custkey")).alias("tx_from"),
            F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
             .otherwise(address_of("t", F.col("o_orderkey"))).alias("tx_to"),
            F.col("o_orderkey").cast("decimal(20,0)").alias("tx_nonce"),
            F.round(F.col("o_totalprice")).cast("decimal(38,0)").alias("tx_gas_price"),
            (F.lit(21000) + F.length("o_orderpriority") * 1000).cast("decimal(20,0)").alias("tx_gas"),
            F.round(F.col("o_totalprice") * 100).cast("decimal(38,0)").alias("tx_value"),
            F.substring("o_orderpriority", 1, 1).cast("smallint").alias("tx_type"),
            F.concat(F.lit("0x"), F.substring(F.md5(F.col("o_orderpriority")), 1, 8)).alias("tx_4bytes"),
        )

    def _order_tx_columns(self) -> list[Column]:
        return [F.col("tx_hash").alias("hash"), F.col("tx_from").alias("from"),
                F.col("tx_to").alias("to"), F.col("tx_nonce").alias("nonce"),
                F.col("tx_gas_price").alias("gas_price"), F.col("tx_gas").alias("gas"),
                F.col("tx_value").alias("value"), F.col("tx_type").alias("type")]

    @cached_property
    def _lines(self) -> DataFrame:
        # Both sides are dealt by the key that a join of large tables deals them by anyway, so
        # attributes are derived in parallel whatever the files' row groups are.
        return self._dealt("lineitem", "l_orderkey") \
            .join(self._orders_tx, F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def mempool_tx(self) -> DataFrame:
        # dimensions chained off the fact side: each join is sized on its own table, so
        # Spark's broadcast threshold decides per dimension (no product-of-sizes estimate)
        lines = (self._lines
                 .join(self.table("supplier").select("s_suppkey", "s_nationkey"),
                       F.col("l_suppkey") == F.col("s_suppkey"), "left")
                 .join(self.table("nation").select("n_nationkey", "n_regionkey"),
                       F.col("s_nationkey") == F.col("n_nationkey"), "left")
                 .join(self.table("region").select("r_regionkey",
                                                   F.col("r_name").alias("meta_client_geo_continent_code")),
                       F.col("n_regionkey") == F.col("r_regionkey"), "left"))
        df = (lines
              .select(F.expr("timestampadd(MINUTE, l_linenumber, l_shipdate)").alias("event_date_time"),
                      *self._order_tx_columns(),
                      (F.length("o_orderpriority") * 10).cast("bigint").alias("size"),
                      F.col("o_custkey").alias("call_data_size"),
                      F.concat(F.lit("sentry-"), F.col("l_suppkey").cast("string")).alias("meta_client_name"),
                      "meta_client_geo_continent_code",
                      F.when(F.col("l_suppkey") % 10 == 0, "holesky").otherwise("mainnet")
                       .alias("meta_network_name")))
        return conform(df, "mempool_transaction")

    @cached_property
    def block_native_tx(self) -> DataFrame:
        l = self._lines
        order = self._order_tx_columns()
        df = l.select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("unique_key"),
            F.col("l_shipdate").alias("updated_date_time"),
            F.expr("timestampadd(HOUR, l_linenumber, l_shipdate)").alias("detecttime"),
            order[0],  # hash
            F.col("l_returnflag").alias("status"), F.col("l_linestatus").alias("region"),
            F.when(F.col("l_linenumber") > 5, F.lit("replaced")).alias("replace"),
            F.when(F.col("l_returnflag") == "A",
                   F.concat(F.lit("depth-"), F.col("l_linenumber").cast("string"))).alias("reorg"),
            F.when(F.col("l_returnflag") == "R",
                   F.concat(F.lit("reverted-"), F.col("l_linenumber").cast("string"))).alias("failurereason"),
            F.col("l_linenumber").cast("decimal(20,0)").alias("blockspending"),
            (F.col("l_linenumber") * 1000).cast("decimal(20,0)").alias("timepending"),
            order[3].alias("nonce"), order[5].alias("gas"), order[4].alias("gasprice"),
            order[6].alias("value"), order[2].alias("toaddress"), order[1].alias("fromaddress"),
            F.col("o_custkey").alias("datasize"),
            F.when(F.col("o_orderstatus") != "F", F.col("tx_4bytes")).alias("data4bytes"),
            F.when(F.col("l_suppkey") % 10 == 0, "goerli").otherwise("main").alias("network"),
            order[7].alias("type"),
            F.round(F.col("l_tax") * 100).cast("decimal(38,0)").alias("maxpriorityfeepergas"),
            F.round(F.col("l_discount") * 1000).cast("decimal(38,0)").alias("maxfeepergas"),
            F.round(F.col("l_extendedprice")).cast("decimal(38,0)").alias("basefeepergas"),
            F.when(F.col("l_linestatus") == "O", F.lit("timeout")).alias("dropreason"),
            F.lit(None).cast("string").alias("rejectionreason"),
            F.round(F.col("l_quantity")).cast("decimal(20,0)").alias("gasused"),
        )
        return conform(df, "block_native_mempool_transaction")

    @cached_property
    def dumpster_tx(self) -> DataFrame:
        order = self._order_tx_columns()
        ts = F.expr("timestampadd(MILLISECOND, o_custkey * 7, o_orderdate)")
        df = self._lines.select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("unique_key"),
            F.col("o_orderdate").alias("updated_date_time"), ts.alias("timestamp"),
            order[0],
            F.when(F.col("o_orderstatus") == "P", F.lit(5)).otherwise(F.lit(1)).cast("bigint").alias("chain_id"),
            order[1], order[2], order[6], order[3], order[5], order[4],
            F.round(F.col("o_totalprice") / 10).cast("decimal(38,0)").alias("gas_tip_cap"),
            F.when(F.col("o_orderstatus") == "F", F.round(F.col("o_totalprice") * 2)
                   .cast("decimal(38,0)")).alias("gas_fee_cap"),
            (F.length("o_orderpriority") * 100).cast("bigint").alias("data_size"),
            F.col("tx_4bytes").alias("data_4bytes"),
            F.split(F.col("o_orderpriority"), "-").alias("sources"),
            F.when(F.col("o_orderstatus") != "O", F.col("o_orderkey").cast("decimal(20,0)"))
             .alias("included_at_block_height"),
            F.when(F.col("o_orderstatus") != "O",
                   F.expr("timestampadd(MILLISECOND, o_custkey * 7 + 12500, o_orderdate)"))
             .alias("included_block_timestamp"),
            F.when(F.col("o_orderstatus") != "O", F.lit(12500).cast("bigint")).alias("inclusion_delay_ms"),
        )
        return conform(df, "mempool_dumpster_transaction")

    @cached_property
    def canonical_tx(self) -> DataFrame:
        o = self._orders_tx
        slot = F.expr(f"timestampdiff(SECOND, {EPOCH0}, o_orderdate) div {TX_SLOT_SECONDS}")
        o = o.withColumn("slot", slot).withColumn("epoch", F.expr("slot div 32"))
        copies = []
        for days in (0, 1):
            copies.append(o.select(
                (F.col("o_orderkey") * 2 + days).alias("unique_key"),
                F.expr(f"o_orderdate + INTERVAL {days} DAY").alias("updated_date_time"),
                F.col("o_orderdate").alias("event_date_time"), "slot",
                F.expr(f"timestampadd(SECOND, slot * {TX_SLOT_SECONDS}, {EPOCH0})").alias("slot_start_date_time"),
                "epoch",
                F.expr(f"timestampadd(SECOND, epoch * {TX_SLOT_SECONDS * 32}, {EPOCH0})").alias("epoch_start_date_time"),
                root_of(F.concat(F.lit("blk"), F.col("slot").cast("string"))).alias("block_root"),
                F.lit("deneb").alias("block_version"),
                F.col("o_custkey").alias("position"),
                *self._order_tx_columns(),
                (F.length("o_orderpriority") * 10).cast("bigint").alias("size"),
                F.col("o_custkey").alias("call_data_size"),
                F.when(F.col("o_orderpriority") == "5-LOW", "sepolia").otherwise("mainnet")
                 .alias("meta_network_name")))
        return conform(copies[0].unionByName(copies[1]),
                       "canonical_beacon_block_execution_transaction")

    # ---- additive partial state -----------------------------------------------------------
    @cached_property
    def slot_partials(self) -> DataFrame:
        df = (self.base.groupBy("slot", "slot_start_date_time", "epoch", "epoch_start_date_time",
                                F.col("event_type").alias("meta_client_name"),
                                "meta_network_name", F.hour("ts").alias("part"))
              .agg(F.count_if(F.col("event_type") == "purchase").alias("blocks"),
                   F.count(F.lit(1)).alias("attestations"))
              .drop("part"))
        return conform(df, "beacon_api_slot")


# source name -> Fixture attribute
ADAPTED = {
    "beacon_api_eth_v1_events_attestation": "attestation",
    "beacon_api_eth_v1_validator_attestation_data": "attestation_data",
    "beacon_api_eth_v1_beacon_committee": "committee",
    "beacon_block_classification": "classification",
    "beacon_api_eth_v1_events_block": "event_block",
    "libp2p_gossipsub_beacon_block": "gossip_block",
    "canonical_beacon_block": "canonical_block",
    "beacon_api_eth_v1_events_blob_sidecar": "event_blob",
    "canonical_beacon_blob_sidecar": "canonical_blob",
    "libp2p_gossipsub_blob_sidecar": "gossip_blob",
    "beacon_api_eth_v2_beacon_block": "api_block",
    "mempool_transaction": "mempool_tx",
    "block_native_mempool_transaction": "block_native_tx",
    "mempool_dumpster_transaction": "dumpster_tx",
    "canonical_beacon_block_execution_transaction": "canonical_tx",
    "beacon_api_slot": "slot_partials",
}


def _get(self: Fixture, name: str) -> DataFrame:
    try:
        return getattr(self, ADAPTED[name])
    except KeyError:
        raise KeyError(f"no fixture adapter for source {name!r}") from None


Fixture.get = _get
