"""Column expressions shared by the operators (all JVM-side built-ins)."""

from rateflow.functions.columns import (
    error_aggs,
    hash_bucket,
    split_part,
    stable_hash_key,
)

__all__ = ["error_aggs", "hash_bucket", "split_part", "stable_hash_key"]
