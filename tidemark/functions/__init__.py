"""Column functions: time buckets, little-endian decoding, protocol accounts."""
