"""Column expressions shared by the feature operators (all JVM built-ins)."""

from basketflow.functions.columns import (  # noqa: F401
    as_flag, avg_double, best_value, count_lines, flag_max, mode_of_counts, nullif_zero, rate, share_of,
    significant,
)
