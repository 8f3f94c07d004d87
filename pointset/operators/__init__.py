from .evaluate import (
    expected_centroids,
    expected_distances,
    match_centroids,
    match_mse,
    nearest_other,
    rms_radius,
)
from .iterations import lloyd, lloyd_step
from .logstats import cache_comparison, series, stage_stats, stage_times
from .nearest import (
    as_points,
    assign,
    centroid_table,
    cluster_sizes,
    cost,
    local_centroids,
    update_centroids,
    update_distances,
)
from .prepare import dense_index, drop_categorical, label_index, min_max, minmax_rescale, numeric_columns
from .profile import (
    distinct_counts,
    label_counts,
    numeric_dim,
    shape,
    table_shape,
    true_k,
    type_profile,
    value_types,
)
from .seeding import (
    candidate_weights,
    dedup,
    extend,
    init_from_set,
    init_from_space,
    init_parallel,
    oversample,
    oversampled_candidates,
    recluster,
    rounds,
    seed_plus_plus,
)

__all__ = [
    "as_points",
    "assign",
    "cache_comparison",
    "candidate_weights",
    "centroid_table",
    "cluster_sizes",
    "cost",
    "dedup",
    "dense_index",
    "distinct_counts",
    "drop_categorical",
    "expected_centroids",
    "expected_distances",
    "extend",
    "init_from_set",
    "init_from_space",
    "init_parallel",
    "label_counts",
    "label_index",
    "lloyd",
    "lloyd_step",
    "local_centroids",
    "match_centroids",
    "match_mse",
    "min_max",
    "minmax_rescale",
    "nearest_other",
    "numeric_columns",
    "numeric_dim",
    "oversample",
    "oversampled_candidates",
    "recluster",
    "rms_radius",
    "rounds",
    "seed_plus_plus",
    "series",
    "shape",
    "stage_stats",
    "stage_times",
    "table_shape",
    "true_k",
    "type_profile",
    "update_centroids",
    "update_distances",
    "value_types",
]
