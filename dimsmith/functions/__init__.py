from dimsmith.functions.hashing import diff_hash, null_hash, hash_hex, hashes_to_hex
from dimsmith.functions.temporal import HIGH_DATE, high_date, load_ts, minus_tick, ts_text
from dimsmith.functions.joins import broadcast_if_small
from dimsmith.functions.windows import full_frame, key_window

__all__ = [
    "null_hash", "diff_hash", "hash_hex", "hashes_to_hex",
    "HIGH_DATE", "high_date", "load_ts", "minus_tick", "ts_text",
    "full_frame", "key_window", "broadcast_if_small",
]
