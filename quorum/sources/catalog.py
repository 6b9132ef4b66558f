"""Typed catalog of the telemetry sources.

Every source is declared once: its Spark schema (DDL), the column the run window filters
on, the network column and predicate value, and -- for tables that are replaced in place
by newer versions -- the dedupe key and the version column used by latest-version reads.

Type mapping: 32-bit unsigned -> bigint, 64-bit unsigned -> decimal(20,0), 128-bit
unsigned -> decimal(38,0) (values above 10^38-1 are rejected by the cast, not wrapped),
fixed-length hex strings -> string, DateTime/DateTime64 -> timestamp_ntz.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Observer block shared by the API tables (client identity, geo, network, consensus client).
META = (
    "meta_client_name string, meta_client_id string, meta_client_version string, "
    "meta_client_implementation string, meta_client_os string, meta_client_ip string, "
    "meta_client_geo_city string, meta_client_geo_country string, "
    "meta_client_geo_country_code string, meta_client_geo_continent_code string, "
    "meta_client_geo_longitude double, meta_client_geo_latitude double, "
    "meta_client_geo_autonomous_system_number bigint, "
    "meta_client_geo_autonomous_system_organization string, meta_network_id int, "
    "meta_network_name string, meta_consensus_version string, "
    "meta_consensus_version_major string, meta_consensus_version_minor string, "
    "meta_consensus_version_patch string, meta_consensus_implementation string, "
    "meta_labels map<string,string>"
)
# Shorter observer block of the libp2p tables.
META_P2P = (
    "meta_client_name string, meta_client_id string, meta_client_version string, "
    "meta_client_implementation string, meta_client_os string, meta_client_ip string, "
    "meta_client_geo_city string, meta_client_geo_country string, "
    "meta_client_geo_country_code string, meta_client_geo_continent_code string, "
    "meta_client_geo_longitude double, meta_client_geo_latitude double, "
    "meta_client_geo_autonomous_system_number bigint, "
    "meta_client_geo_autonomous_system_organization string, meta_network_id int, "
    "meta_network_name string"
)
SLOT_COLS = ("slot bigint, slot_start_date_time timestamp_ntz, epoch bigint, "
             "epoch_start_date_time timestamp_ntz")
CANON = ("unique_key bigint, updated_date_time timestamp_ntz, event_date_time timestamp_ntz, "
         + SLOT_COLS + ", block_root string, block_version string")
TX_COLS = ("nonce decimal(20,0), gas_price decimal(38,0), gas decimal(20,0), "
           "value decimal(38,0)")


@dataclass(frozen=True)
class Source:
    name: str
    ddl: str
    time_col: str | None = "slot_start_date_time"
    network_col: str | None = "meta_network_name"
    key: tuple[str, ...] = ()
    version: tuple[str, ...] = ()
    read_by: tuple[str, ...] = field(default_factory=tuple)

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def replacing(self) -> bool:
        return bool(self.key)


_S = Source
SOURCES: dict[str, Source] = {s.name: s for s in [
    # ---- read by a job -------------------------------------------------------------------
    _S("beacon_api_eth_v1_events_blob_sidecar",
       "event_date_time timestamp_ntz, slot bigint, slot_start_date_time timestamp_ntz, "
       "propagation_slot_start_diff bigint, epoch bigint, epoch_start_date_time timestamp_ntz, "
       "block_root string, blob_index decimal(20,0), kzg_commitment string, "
       "versioned_hash string, " + META, read_by=("block_blobs",)),
    _S("beacon_api_eth_v1_events_block",
       "event_date_time timestamp_ntz, slot bigint, slot_start_date_time timestamp_ntz, "
       "propagation_slot_start_diff bigint, block string, epoch bigint, "
       "epoch_start_date_time timestamp_ntz, execution_optimistic boolean, " + META,
       read_by=("blocks",)),
    _S("beacon_api_eth_v1_events_attestation",
       "event_date_time timestamp_ntz, slot bigint, slot_start_date_time timestamp_ntz, "
       "propagation_slot_start_diff bigint, committee_index string, "
       "attesting_validator_index bigint, attesting_validator_committee_index string, "
       "signature string, aggregation_bits string, beacon_block_root string, epoch bigint, "
       "epoch_start_date_time timestamp_ntz, source_epoch bigint, "
       "source_epoch_start_date_time timestamp_ntz, source_root string, target_epoch bigint, "
       "target_epoch_start_date_time timestamp_ntz, target_root string, " + META,
       read_by=("network_participation", "attesting_validators",
                "offline_attesting_validators", "attestation_nearest_client")),
    _S("mempool_transaction",
       "event_date_time timestamp_ntz, hash string, `from` string, `to` string, " + TX_COLS
       + ", type smallint, size bigint, call_data_size bigint, gas_tip_cap decimal(38,0), "
       "gas_fee_cap decimal(38,0), blob_gas decimal(20,0), blob_gas_fee_cap decimal(38,0), "
       "blob_hashes array<string>, blob_sidecars_size bigint, blob_sidecars_empty_size bigint, "
       + META_P2P + ", meta_execution_fork_id_hash string, meta_execution_fork_id_next string, "
       "meta_labels map<string,string>",
       time_col="event_date_time", read_by=("transaction_sightings", "transaction_hashes")),
    _S("beacon_api_eth_v2_beacon_block",
       "event_date_time timestamp_ntz, " + SLOT_COLS + ", block_root string, "
       "block_version string, block_total_bytes bigint, block_total_bytes_compressed bigint, "
       "parent_root string, state_root string, proposer_index bigint, "
       "eth1_data_block_hash string, eth1_data_deposit_root string, "
       "execution_payload_block_hash string, execution_payload_block_number bigint, "
       "execution_payload_fee_recipient string, execution_payload_state_root string, "
       "execution_payload_parent_hash string, execution_payload_transactions_count bigint, "
       "execution_payload_transactions_total_bytes bigint, "
       "execution_payload_transactions_total_bytes_compressed bigint, " + META,
       read_by=("block_blobs",)),
    _S("beacon_api_eth_v1_validator_attestation_data",
       "event_date_time timestamp_ntz, slot bigint, slot_start_date_time timestamp_ntz, "
       "beacon_block_root string, committee_index string, epoch bigint, "
       "epoch_start_date_time timestamp_ntz, source_epoch bigint, "
       "source_epoch_start_date_time timestamp_ntz, source_root string, target_epoch bigint, "
       "target_epoch_start_date_time timestamp_ntz, target_root string, "
       "request_date_time timestamp_ntz, request_duration bigint, "
       "request_slot_start_diff bigint, " + META, read_by=("attestation_divergence",)),
    _S("canonical_beacon_block",
       "updated_date_time timestamp_ntz, event_date_time timestamp_ntz, " + SLOT_COLS
       + ", block_root string, block_version string, block_total_bytes bigint, "
       "block_total_bytes_compressed bigint, parent_root string, state_root string, "
       "proposer_index bigint, eth1_data_block_hash string, eth1_data_deposit_root string, "
       "execution_payload_block_hash string, execution_payload_block_number bigint, "
       "execution_payload_fee_recipient string, execution_payload_state_root string, "
       "execution_payload_parent_hash string, execution_payload_transactions_count bigint, "
       "execution_payload_transactions_total_bytes bigint, "
       "execution_payload_transactions_total_bytes_compressed bigint, " + META,
       key=("slot", "block_root", "meta_network_name"), version=("updated_date_time",),
       read_by=("blocks", "block_blobs")),
    _S("canonical_beacon_block_execution_transaction",
       CANON + ", position bigint, hash string, `from` string, `to` string, " + TX_COLS
       + ", type smallint, size bigint, call_data_size bigint, gas_tip_cap decimal(38,0), "
       "gas_fee_cap decimal(38,0), blob_gas decimal(20,0), blob_gas_fee_cap decimal(38,0), "
       "blob_hashes array<string>, blob_sidecars_size bigint, blob_sidecars_empty_size bigint, "
       + META, key=("unique_key",), version=("updated_date_time",),
       read_by=("transaction_canonical", "transaction_hashes")),
    _S("beacon_block_classification",
       "updated_date_time timestamp_ntz, event_date_time timestamp_ntz, " + SLOT_COLS
       + ", best_guess_single string, best_guess_multi string, "
       "client_probability_uncertain float, client_probability_prysm float, "
       "client_probability_teku float, client_probability_nimbus float, "
       "client_probability_lodestar float, client_probability_grandine float, "
       "client_probability_lighthouse float, proposer_index bigint, " + META,
       key=("slot", "proposer_index", "meta_network_name"), version=("updated_date_time",),
       read_by=("attesting_validators", "offline_attesting_validators")),
    _S("beacon_api_eth_v1_beacon_committee",
       "event_date_time timestamp_ntz, " + SLOT_COLS + ", committee_index string, "
       "validators array<bigint>, " + META,
       read_by=("network_participation", "offline_attesting_validators")),
    _S("canonical_beacon_blob_sidecar",
       CANON.replace(", block_version string", "") + ", versioned_hash string, "
       "kzg_commitment string, kzg_proof string, proposer_index bigint, "
       "blob_index decimal(20,0), blob_size bigint, blob_empty_size bigint, " + META,
       key=("unique_key",), version=("updated_date_time",), read_by=("block_blobs",)),
    _S("block_native_mempool_transaction",
       "unique_key bigint, updated_date_time timestamp_ntz, detecttime timestamp_ntz, "
       "hash string, status string, region string, reorg string, replace string, "
       "curblocknumber decimal(20,0), failurereason string, blockspending decimal(20,0), "
       "timepending decimal(20,0), nonce decimal(20,0), gas decimal(20,0), "
       "gasprice decimal(38,0), value decimal(38,0), toaddress string, fromaddress string, "
       "datasize bigint, data4bytes string, network string, type smallint, "
       "maxpriorityfeepergas decimal(38,0), maxfeepergas decimal(38,0), "
       "basefeepergas decimal(38,0), dropreason string, rejectionreason string, "
       "stuck boolean, gasused decimal(20,0)",
       time_col="detecttime", network_col="network", key=("unique_key",),
       version=("updated_date_time",),
       read_by=("transaction_block_native", "transaction_hashes")),
    _S("mempool_dumpster_transaction",
       "unique_key bigint, updated_date_time timestamp_ntz, timestamp timestamp_ntz, "
       "hash string, chain_id bigint, `from` string, `to` string, value decimal(38,0), "
       "nonce decimal(20,0), gas decimal(20,0), gas_price decimal(38,0), "
       "gas_tip_cap decimal(38,0), gas_fee_cap decimal(38,0), data_size bigint, "
       "data_4bytes string, sources array<string>, included_at_block_height decimal(20,0), "
       "included_block_timestamp timestamp_ntz, inclusion_delay_ms bigint",
       time_col="timestamp", network_col="chain_id", key=("unique_key",),
       version=("updated_date_time",),
       read_by=("transaction_mempool_dumpster", "transaction_hashes")),
    _S("libp2p_gossipsub_beacon_block",
       "unique_key bigint, updated_date_time timestamp_ntz, event_date_time timestamp_ntz, "
       + SLOT_COLS + ", wallclock_slot bigint, wallclock_slot_start_date_time timestamp_ntz, "
       "wallclock_epoch bigint, wallclock_epoch_start_date_time timestamp_ntz, "
       "propagation_slot_start_diff bigint, block string, proposer_index bigint, "
       "peer_id_unique_key bigint, message_id string, message_size bigint, "
       "topic_layer string, topic_fork_digest_value string, topic_name string, "
       "topic_encoding string, " + META_P2P,
       key=("unique_key",), version=("updated_date_time",), read_by=("blocks",)),
    _S("libp2p_gossipsub_blob_sidecar",
       "unique_key bigint, updated_date_time timestamp_ntz, event_date_time timestamp_ntz, "
       + SLOT_COLS + ", wallclock_slot bigint, wallclock_slot_start_date_time timestamp_ntz, "
       "wallclock_epoch bigint, wallclock_epoch_start_date_time timestamp_ntz, "
       "propagation_slot_start_diff bigint, proposer_index bigint, blob_index bigint, "
       "parent_root string, state_root string, peer_id_unique_key bigint, message_id string, "
       "message_size bigint, topic_layer string, topic_fork_digest_value string, "
       "topic_name string, topic_encoding string, " + META_P2P,
       key=("unique_key",), version=("updated_date_time",), read_by=("block_blobs",)),
    # ---- declared, read by no job ----------------------------------------------------------
    _S("beacon_api_eth_v1_events_head",
       "event_date_time timestamp_ntz, slot bigint, slot_start_date_time timestamp_ntz, "
       "propagation_slot_start_diff bigint, block string, epoch bigint, "
       "epoch_start_date_time timestamp_ntz, epoch_transition boolean, "
       "execution_optimistic boolean, previous_duty_dependent_root string, "
       "current_duty_dependent_root string, " + META),
    _S("beacon_api_eth_v1_events_voluntary_exit",
       "event_date_time timestamp_ntz, epoch bigint, epoch_start_date_time timestamp_ntz, "
       "validator_index bigint, signature string, " + META, time_col="epoch_start_date_time"),
    _S("beacon_api_eth_v1_events_finalized_checkpoint",
       "event_date_time timestamp_ntz, block string, state string, epoch bigint, "
       "epoch_start_date_time timestamp_ntz, execution_optimistic boolean, " + META,
       time_col="epoch_start_date_time"),
    _S("beacon_api_eth_v1_events_chain_reorg",
       "event_date_time timestamp_ntz, slot bigint, slot_start_date_time timestamp_ntz, "
       "propagation_slot_start_diff bigint, depth int, old_head_block string, "
       "new_head_block string, old_head_state string, new_head_state string, epoch bigint, "
       "epoch_start_date_time timestamp_ntz, execution_optimistic boolean, " + META),
    _S("beacon_api_eth_v1_events_contribution_and_proof",
       "event_date_time timestamp_ntz, aggregator_index bigint, contribution_slot bigint, "
       "contribution_slot_start_date_time timestamp_ntz, "
       "contribution_propagation_slot_start_diff bigint, "
       "contribution_beacon_block_root string, contribution_subcommittee_index string, "
       "contribution_aggregation_bits string, contribution_signature string, "
       "contribution_epoch bigint, contribution_epoch_start_date_time timestamp_ntz, "
       "selection_proof string, signature string, " + META,
       time_col="contribution_slot_start_date_time"),
    _S("beacon_api_slot",
       "slot bigint, slot_start_date_time timestamp_ntz, epoch bigint, "
       "epoch_start_date_time timestamp_ntz, meta_client_name string, "
       "meta_network_name string, meta_client_geo_city string, "
       "meta_client_geo_continent_code string, meta_client_geo_longitude double, "
       "meta_client_geo_latitude double, meta_consensus_implementation string, "
       "meta_consensus_version string, blocks bigint, attestations bigint"),
    _S("canonical_beacon_block_proposer_slashing",
       CANON + ", signed_header_1_message_slot bigint, "
       "signed_header_1_message_proposer_index bigint, signed_header_1_message_body_root string, "
       "signed_header_1_message_parent_root string, signed_header_1_message_state_root string, "
       "signed_header_1_signature string, signed_header_2_message_slot bigint, "
       "signed_header_2_message_proposer_index bigint, signed_header_2_message_body_root string, "
       "signed_header_2_message_parent_root string, signed_header_2_message_state_root string, "
       "signed_header_2_signature string, " + META,
       key=("unique_key",), version=("updated_date_time",)),
    _S("canonical_beacon_block_attester_slashing",
       CANON + ", attestation_1_attesting_indices array<bigint>, attestation_1_signature string, "
       "attestation_1_data_beacon_block_root string, attestation_1_data_slot bigint, "
       "attestation_1_data_index bigint, attestation_1_data_source_epoch bigint, "
       "attestation_1_data_source_root string, attestation_1_data_target_epoch bigint, "
       "attestation_1_data_target_root string, attestation_2_attesting_indices array<bigint>, "
       "attestation_2_signature string, attestation_2_data_beacon_block_root string, "
       "attestation_2_data_slot bigint, attestation_2_data_index bigint, "
       "attestation_2_data_source_epoch bigint, attestation_2_data_source_root string, "
       "attestation_2_data_target_epoch bigint, attestation_2_data_target_root string, " + META,
       key=("unique_key",), version=("updated_date_time",)),
    _S("canonical_beacon_block_bls_to_execution_change",
       CANON + ", exchanging_message_validator_index bigint, "
       "exchanging_message_from_bls_pubkey string, "
       "exchanging_message_to_execution_address string, exchanging_signature string, " + META,
       key=("unique_key",), version=("updated_date_time",)),
    _S("canonical_beacon_block_voluntary_exit",
       CANON + ", voluntary_exit_message_epoch bigint, "
       "voluntary_exit_message_validator_index bigint, voluntary_exit_signature string, "
       + META, key=("unique_key",), version=("updated_date_time",)),
    _S("canonical_beacon_block_deposit",
       CANON + ", deposit_proof array<string>, deposit_data_pubkey string, "
       "deposit_data_withdrawal_credentials string, deposit_data_amount decimal(38,0), "
       "deposit_data_signature string, " + META,
       key=("unique_key",), version=("updated_date_time",)),
    _S("canonical_beacon_block_withdrawal",
       CANON + ", withdrawal_index bigint, withdrawal_validator_index bigint, "
       "withdrawal_address string, withdrawal_amount decimal(38,0), " + META,
       key=("unique_key",), version=("updated_date_time",)),
    _S("beacon_p2p_attestation",
       "unique_key bigint, updated_date_time timestamp_ntz, event_date_time timestamp_ntz, "
       "slot bigint, slot_start_date_time timestamp_ntz, propagation_slot_start_diff bigint, "
       "committee_index string, attesting_validator_index bigint, "
       "attesting_validator_committee_index string, aggregation_bits string, "
       "beacon_block_root string, epoch bigint, epoch_start_date_time timestamp_ntz, "
       "source_epoch bigint, source_epoch_start_date_time timestamp_ntz, source_root string, "
       "target_epoch bigint, target_epoch_start_date_time timestamp_ntz, target_root string, "
       "attestation_subnet string, validated boolean, peer_id string, peer_latency bigint, "
       "peer_version string, peer_version_major string, peer_version_minor string, "
       "peer_version_patch string, peer_implementation string, peer_ip string, "
       "peer_geo_city string, peer_geo_country string, peer_geo_country_code string, "
       "peer_geo_continent_code string, peer_geo_longitude double, peer_geo_latitude double, "
       "peer_geo_autonomous_system_number bigint, "
       "peer_geo_autonomous_system_organization string, " + META,
       key=("unique_key",), version=("updated_date_time",)),
    _S("canonical_beacon_elaborated_attestation",
       "unique_key bigint, updated_date_time timestamp_ntz, event_date_time timestamp_ntz, "
       "block_slot bigint, block_slot_start_date_time timestamp_ntz, block_epoch bigint, "
       "block_epoch_start_date_time timestamp_ntz, position_in_block bigint, "
       "block_root string, validators array<bigint>, committee_index string, "
       "beacon_block_root string, " + SLOT_COLS + ", source_epoch bigint, "
       "source_epoch_start_date_time timestamp_ntz, source_root string, target_epoch bigint, "
       "target_epoch_start_date_time timestamp_ntz, target_root string, " + META,
       key=("unique_key",), version=("updated_date_time",)),
    _S("canonical_beacon_proposer_duty",
       "unique_key bigint, updated_date_time timestamp_ntz, event_date_time timestamp_ntz, "
       + SLOT_COLS + ", proposer_validator_index bigint, proposer_pubkey string, " + META,
       key=("unique_key",), version=("updated_date_time",)),
]}


def source(name: str) -> Source:
    try:
        return SOURCES[name]
    except KeyError:
        raise KeyError(f"unknown source {name!r}; known: {sorted(SOURCES)}") from None


def conform(df: DataFrame, name: str, strict: bool = False, fill: bool = False) -> DataFrame:
    """Check ``df`` against the declared schema and cast to the declared types.

    Columns the declaration lacks are an error; declared columns ``df`` lacks are allowed
    unless ``strict`` (adapters only build what the jobs read), and added as typed NULLs
    when ``fill``.  A number beyond its declared decimal (a 128-bit integer can have 39
    digits, Spark's decimals hold 38) becomes NULL instead of ending the job; ``violations``
    on the frame as it came counts such rows.
    """
    declared = {f.name: f.dataType for f in source(name).schema.fields}
    extra = [c for c in df.columns if c not in declared]
    if extra:
        raise ValueError(f"{name}: undeclared columns {extra}")
    if strict:
        missing = [c for c in declared if c not in df.columns]
        if missing:
            raise ValueError(f"{name}: missing columns {missing}")
    def typed(c: str):
        decimal = declared[c].typeName().startswith("decimal")
        return (F.col(f"`{c}`").try_cast(declared[c]) if decimal else F.col(f"`{c}`").cast(declared[c])).alias(c)

    cols = [typed(c) for c in df.columns]
    if fill:
        cols += [F.lit(None).cast(t).alias(c) for c, t in declared.items() if c not in df.columns]
    return df.select(cols)
