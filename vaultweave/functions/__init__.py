from vaultweave.functions.hashing import hash_composite, hash_diff, hash_key, norm_text
from vaultweave.functions.time import (
    epoch_ms_to_ts,
    in_year,
    load_date_of,
    ts_literal,
    ts_to_epoch_ms,
    year_start,
)

__all__ = [
    "norm_text", "hash_key", "hash_composite", "hash_diff",
    "ts_literal", "year_start", "in_year", "load_date_of", "epoch_ms_to_ts", "ts_to_epoch_ms",
]
