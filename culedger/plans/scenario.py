"""Parameters of the registered queries, shared by the Spark side and the SQL
oracle so both read the same scope."""

# Scenario parameters.
#: Inclusive analysis window of the ``filter_window`` query (the filter is
#: the feature there); every other query reads whole tables.
FILTER_WINDOW = ("05 January 2024 07:30", "20 January 2024 20:59")
#: Work-list window: the whole month the driver tables cover.
MONTH_WINDOW = ("01 January 2024 00:00", "31 January 2024 23:59")
#: Incremental-load scenario: run 1 loaded rows up to this load time,
#: run 2 loaded rows from ``RUN2_FROM`` on (the runs overlap, so merges see
#: matches, misses and NULL keys).
RUN1_BEFORE = "2024-01-20 00:00:00"
RUN2_FROM = "2024-01-15 00:00:00"
#: Operation id inspected by ``inspect_operation`` (single-operation view).
INSPECT_OPERATION_ID = "op-7"
#: Capacity id given in lower case to the case-insensitive filter.
CI_CAPACITY_ID = "cap-01"
#: Capacity for the exact filter.
CAPACITY_ID = "CAP-02"
#: Capacity whose units are staged again with nothing in them.
EMPTIED_CAPACITY_ID = "CAP-03"
TOP_N = 20
#: CU seconds of a timepoint from which it is busy.
BUSY_CU = 180.0
