"""Fixed-layout decoding of raw ledger values, and protocol accounts."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: The base-58 alphabet, and what begins the account id of a protocol account.
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
PROTOCOL_MAGIC = b"modl"
#: Fixed value: what an address checksum is taken over, before the data.
CHECKSUM_PREFIX = b"SS58PRE"
#: Byte offsets of the free and reserved balance in an account record, and their length.
FREE_AT, RESERVED_AT, BALANCE_BYTES = 16, 24, 8


def bare(hex_: Column) -> Column:
    """Hex digits without 0x."""
    return F.when(hex_.startswith("0x"), F.substring(hex_, 3, (1 << 31) - 1)).otherwise(hex_)


def little_endian(hex_: Column, at: int = 0, size: int = 8) -> Column:
    """An unsigned little-endian integer of up to 8 bytes at a byte offset of hex digits, as DECIMAL(20,0); null if the digits end early.

    The bytes are cut out of digits that are null if they end early, not under a condition: so Spark makes them once a row.
    """
    own = F.substring(hex_, 2 * at + 1, 2 * size)
    own = F.when(F.length(own) == 2 * size, own)
    digits = F.concat(*[F.substring(own, 2 * k + 1, 2) for k in reversed(range(size))])
    return F.conv(digits, 16, 10).cast("decimal(20,0)")


def block_timestamp(hex_: str | Column) -> Column:
    """Epoch milliseconds from a block's little-endian hex; null stays null."""
    hex_ = F.col(hex_) if isinstance(hex_, str) else hex_
    return little_endian(bare(hex_)).cast("long")


def account_balances(df: DataFrame, hex_: str = "account_info_hex") -> DataFrame:
    """df with free_rao and reserved_rao, DECIMAL(20,0); a null record reads as two zeros."""
    digits = bare(F.coalesce(F.col(hex_), F.lit("00" * (RESERVED_AT + BALANCE_BYTES))))
    return df.withColumns({"free_rao": little_endian(digits, FREE_AT, BALANCE_BYTES), "reserved_rao": little_endian(digits, RESERVED_AT, BALANCE_BYTES)})


def account_id(storage_key: str) -> Column:
    """Hex of the account id: the last 32 bytes of an 80-byte storage key."""
    return F.substring(bare(F.col(storage_key)), 2 * 48 + 1, 64)


def _to_base58(data: bytes) -> str:
    number, found = int.from_bytes(data, "big"), ""
    while number:
        number, digit = divmod(number, 58)
        found = BASE58[digit] + found
    return "1" * (len(data) - len(data.lstrip(b"\0"))) + found


def _from_base58(address: str) -> bytes | None:
    if not address or any(c not in BASE58 for c in address):
        return None
    number = 0
    for c in address:
        number = number * 58 + BASE58.index(c)
    return bytes(len(address) - len(address.lstrip("1"))) + number.to_bytes((number.bit_length() + 7) // 8, "big")


def address_of(account: str | None, network: int = 42) -> str | None:
    """The address of an account id in hex: network, id and the first two bytes of their checksum, in base 58."""
    if account is None:
        return None
    data = bytes([network]) + bytes.fromhex(account)
    return _to_base58(data + hashlib.blake2b(CHECKSUM_PREFIX + data).digest()[:2])


@F.pandas_udf(StringType())
def address(accounts: pd.Series) -> pd.Series:
    return accounts.map(address_of)


@F.pandas_udf(StringType())
def account_hex(addresses: pd.Series) -> pd.Series:
    """Hex of the account id in an address; null for what is no address of 32 bytes."""
    found = addresses.map(lambda a: _from_base58(a) if a else None)
    return found.map(lambda d: d[1:33].hex() if d is not None and len(d) == 35 else None)


def pallet_of(address: str | None) -> str | None:
    """The protocol module's id that an address encodes, or None for ordinary and malformed addresses."""
    data = _from_base58(address) if address else None
    if data is None or len(data) < 3:
        return None
    body = data[2 if data[0] & 0x40 else 1 :]
    if len(body) < 12 or body[:4] != PROTOCOL_MAGIC:
        return None
    return body[4:12].rstrip(b"\0").decode("ascii", "replace") or None


@F.pandas_udf(StringType())
def pallet_id(addresses: pd.Series) -> pd.Series:
    return addresses.map(pallet_of)


def protocol_accounts(legs: DataFrame, *columns: str) -> DataFrame:
    """(coldkey, pallet_id) of the protocol accounts among the distinct addresses of some columns; each address is decoded once."""
    names = F.explode(F.array(*[F.col(c) for c in columns])).alias("coldkey")
    return legs.select(names).where("coldkey is not null").distinct().withColumn("pallet_id", pallet_id("coldkey")).where("pallet_id is not null")


def keyword_slug(keyword: str) -> Column:
    """Lower case, with every run of other characters than a-z and 0-9 as one hyphen."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.col(keyword)), "[^a-z0-9]+", "-"), "^-|-$", "")
