from culedger.functions.columns import (  # noqa: F401
    CU_DECIMAL,
    cu_sum,
    exact_cu,
    half_minute_by_format,
    half_minute_by_text,
    make_timepoint,
    parse_window_bound,
    synthetic_operation_id,
    trunc_seconds,
    with_synthetic_operation_id,
)
