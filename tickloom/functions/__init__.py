from tickloom.functions.numeric import decode_double, decode_long, decode_text
from tickloom.functions.text import (
    compact_notional, compact_volume, known, money, price_label, price_label_fine,
    row_key, zfill,
)
from tickloom.functions.time import epoch_seconds, instant, parse_mixed_ts

__all__ = [
    "compact_notional", "compact_volume", "decode_double", "decode_long", "decode_text",
    "epoch_seconds", "instant", "known", "money", "parse_mixed_ts", "price_label",
    "price_label_fine", "row_key", "zfill",
]
