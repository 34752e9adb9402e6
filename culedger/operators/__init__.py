from culedger.operators.aggregates import (  # noqa: F401
    autoscale_summary,
    calendar,
    detail_summary,
    latest_cumulative,
    null_key_audit,
    silver_stats,
    top_items,
    top_k,
    top_operations,
    top_workspaces,
)
from culedger.operators.dedupe import dedupe_any, dedupe_first, dedupe_latest, duplicate_count, require_unique  # noqa: F401
from culedger.operators.filters import (  # noqa: F401
    delete_half_minute_format,
    delete_half_minute_text,
    delete_where,
    drop_half_minute,
    exclude_null_key,
    filter_capacity,
    filter_capacity_ci,
    filter_operation_id,
    filter_window,
    scope,
    semi_filter,
)
from culedger.operators.joins import latest_state, latest_state_strict, star_facts  # noqa: F401
from culedger.operators.running import running_sum  # noqa: F401
from culedger.operators.union import unified_operations  # noqa: F401
from culedger.operators.upsert import upsert, upsert_detail  # noqa: F401
