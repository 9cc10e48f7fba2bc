"""Explicit schemas of the persisted tables; nothing is inferred."""

from __future__ import annotations

RAO, RAO_SUM = "decimal(20,0)", "decimal(38,0)"

SCHEMAS = {
    "ohlcv_1m": "exchange string, pair string, timestamp_ms long, open double, high double, low double, close double, base_volume double, quote_volume double, is_partial boolean",
    "chain_events": "block_number long, block_hash string, events_hex string, timestamp_hex string, spec_version int",
    "decoded_events": "block_number long, timestamp_ms long, spec_version int, events array<struct<section:string,method:string,data:array<string>>>",
    "chain_metadata": "spec_version int, metadata_hex string, captured_at_block long",
    "raw_account_snapshots": "block_number long, block_hash string, spec_version int, coldkey string, storage_key string, account_info_hex string",
    "google_trends": "keyword string, week_start_ms long, value double, is_partial boolean, fetched_at_ms long",
    "youtube_stats": "channel_id string, handle string, title string, date date, view_count long, subscriber_count long, video_count long, fetched_at_ms long",
    "transfers": f"block_number long, event_index int, timestamp_ms long, from_coldkey string, to_coldkey string, amount_rao {RAO}",
    "balance_events": f"block_number long, event_index int, timestamp_ms long, kind string, coldkey string, amount_rao {RAO}",
    "stake_events": f"block_number long, event_index int, timestamp_ms long, kind string, hotkey string, amount_rao {RAO}",
    "account_snapshots": f"block_number long, timestamp_ms long, coldkey string, free_rao {RAO}, reserved_rao {RAO}",
    "pallet_accounts": "coldkey string, pallet_id string",
    "exchange_labels": "coldkey string, exchange string, confidence string, date_added string, evidence string",
    "ingestion_log": "exchange string, pair string, run_at_ms long, rows_fetched long, gap_start_ms long, gap_end_ms long, missing_buckets long",
    "runtime_versions": "from_block long, to_block long, spec_version int",
    "account_balances_daily": f"coldkey string, timestamp_ms long, balance_rao {RAO_SUM}",
}
