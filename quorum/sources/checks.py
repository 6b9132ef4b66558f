"""S1 checks: format rules of the declared sources, counted in one pass.

The source system declares fixed-length hex strings (FixedString(66 / 42 / 98 / 10)) and
128-bit unsigned integers; Spark holds them as strings and decimal(38,0).  These rules
are checked, never enforced by padding or truncation: ``violations`` counts the rows
breaking each rule with a single aggregation (one pass, partial aggregation map-side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorum.sources.catalog import source

# Hex widths by column role ('0x' + hex digits).
HEX_DIGITS = {
    "hash": 64,        # block roots, state roots, transaction hashes
    "address": 40,     # account addresses
    "selector": 8,     # four-byte call selectors
    "commitment": 96,  # KZG commitments and proofs
}

_ROLE_BY_NAME = {
    "address": ("from", "to", "fromaddress", "toaddress", "execution_payload_fee_recipient",
                "withdrawal_address", "exchanging_message_to_execution_address"),
    "selector": ("data4bytes", "data_4bytes", "call_data_4_bytes"),
    "commitment": ("kzg_commitment", "kzg_proof"),
}
_HASH_SUFFIXES = ("_root", "hash", "block", "versioned_hash", "old_head_block",
                  "new_head_block", "old_head_state", "new_head_state")


def role(column: str) -> str | None:
    for r, names in _ROLE_BY_NAME.items():
        if column in names:
            return r
    if column == "block" or column == "hash" or column.endswith(_HASH_SUFFIXES):
        return "hash"
    return None


def rules(df: DataFrame, name: str) -> list[tuple[str, str, Column]]:
    """(column, rule, violated?) for every checkable column present in ``df``."""
    declared = {f.name: f.dataType.simpleString() for f in source(name).schema.fields}
    out = []
    for col in df.columns:
        c = F.col(f"`{col}`")
        t = declared.get(col, "")
        r = role(col) if t == "string" else None
        if r:
            pattern = f"^0x[0-9a-f]{{{HEX_DIGITS[r]}}}$"
            out.append((col, f"{r}_hex_{HEX_DIGITS[r]}", c.isNotNull() & ~c.rlike(pattern)))
        if t == "decimal(38,0)":
            # on the frame as it came: what ``conform`` turns to NULL, and negatives
            number = c.try_cast("decimal(38,0)")
            out.append((col, "uint128_range", c.isNotNull() & (number.isNull() | (number < 0))))
    return out


def violations(df: DataFrame, name: str) -> DataFrame:
    """One row per (column, rule): rows checked and rows violating the rule."""
    rs = rules(df, name)
    if not rs:
        return df.sparkSession.createDataFrame([], "column string, rule string, checked bigint, violations bigint")
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(v).alias(f"_v{i}") for i, (_, _, v) in enumerate(rs)])
    stack = ", ".join(f"'{c}', '{r}', _v{i}" for i, (c, r, _) in enumerate(rs))
    return agg.selectExpr(f"stack({len(rs)}, {stack}) AS (column, rule, violations)", "_n AS checked") \
              .select("column", "rule", "checked", F.col("violations").cast("bigint"))
