from panelmill.functions.dates import date_parts, month_start
from panelmill.functions.numeric import change, classify, pct_change, ratio, snap_round
from panelmill.functions.text import clean_group, decode_key, last_segment, parse_names

__all__ = [
    "change", "classify", "clean_group", "date_parts", "decode_key", "last_segment",
    "month_start", "parse_names", "pct_change", "ratio", "snap_round",
]
