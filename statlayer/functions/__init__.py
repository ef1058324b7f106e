"""Scalar column expressions (built-in Spark functions only, except the accent fold helper)."""
from statlayer.functions.numeric import (  # noqa: F401
    gap_ratio, int_div, nan_to_null, null_skipping_sum, pct_change, ratio_pct, round_half_even, safe_div,
    sql_round, to_double_lenient,
)
from statlayer.functions.text import (  # noqa: F401
    blank_to_null, first_present, is_number_name, plain_letters, slug, strip_all, strip_leading, zero_pad,
)
