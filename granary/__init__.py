"""Batch analytics on layered tables with Spark: read, repair, clean, check, summarise, enrich."""

from granary.operators.cleaning import (
    add_ratio,
    cast_columns,
    clean_text,
    conform,
    dedupe,
    evaluate_once,
    handle_missing,
    normalize_key,
    null_markers,
    null_sentinels,
    rename_columns,
    standardize_name,
)
from granary.operators.heavy import join_heavy
from granary.operators.marts import (
    enrich,
    repeated_keys,
    summarize,
    summarize_normalized,
    summarize_through,
    validate_mart,
)
from granary.operators.quality import (
    SCORED_CHECKS,
    Watch,
    assess,
    assess_watched,
    check_schema,
    completeness,
    consistency,
    key_duplicates,
    outliers_iqr,
    outliers_z,
    profile,
    quality_report,
    quality_score,
    rare_values,
    top_values,
    top_values_bounded,
    uniqueness,
    validity,
    value_counts,
)
from granary.operators.quality_state import (
    assess_states,
    partition_states,
    read_states,
    refresh_states,
    state_distinct,
    state_outliers,
    state_quantiles,
)
from granary.operators.quantiles import approximate_quantiles, exact_quantiles
from granary.operators.repair import repair_rows, split_corrupt, unpack_delimited
from granary.operators.rules import (
    drop_blank_rows,
    keep_valid,
    metric_counts,
    reject_counts,
    require,
)
from granary.sources.delimited import (
    has_multi_line_records,
    read_delimited,
    read_records,
    read_source,
    stream_source,
)
from granary.sources.rowstore import append_new, stored_rows
from granary.sources.tables import (
    load_table,
    register_table,
    run_summary,
    stage,
    staging_folder,
    table_counts,
    write_bucketed,
    write_table,
)
from granary.spec import Agg, Enrichment, QualitySpec, RatioCheck, Rule, SourceSpec

__all__ = [name for name in dir() if not name.startswith("_")]
