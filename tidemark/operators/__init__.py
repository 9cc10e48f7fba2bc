"""DataFrame operators for prices, ledgers, data quality, raw blocks and reconciliation."""
