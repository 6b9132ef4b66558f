from quorum.functions.keys import surrogate_key, naive_concat_key
from quorum.functions.timefns import (format_ts, interval, ntz, parse_ts_or_null, shift,
                                      truncate_to_second)
from quorum.functions.sets import distinct_set, set_string, without

__all__ = [
    "surrogate_key", "naive_concat_key", "ntz", "interval", "shift", "truncate_to_second",
    "format_ts", "parse_ts_or_null",
    "distinct_set", "set_string", "without",
]
