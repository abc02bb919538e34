"""Column-level building blocks. Every function returns a `Column` made of
built-in Catalyst expressions, so it stays inside whole-stage codegen."""

from quire.functions.text import (check_vocab, mentions, sql_string, term_index, tokens, vocab_array,
                                  vocab_array_sql)
from quire.functions.buckets import age_bucket, hours_sum, quoted, sex_bucket, sql_name, working_status
from quire.functions.geometry import int_div, nearest_center, sq_distance
from quire.functions.hashing import md5_prefix32, md5_rank_key

__all__ = [
    "mentions", "tokens", "vocab_array", "vocab_array_sql", "term_index", "check_vocab", "sql_string",
    "working_status", "sex_bucket", "age_bucket", "hours_sum", "quoted", "sql_name",
    "nearest_center", "sq_distance", "int_div", "md5_rank_key", "md5_prefix32",
]
