from tabgrad.sources.readers import (
    extract_labels,
    features_from_columns,
    features_from_vectors,
    inline_values,
    read_biases,
    read_features,
    read_labels,
    read_params,
    read_table,
    read_weight_rows,
)
from tabgrad.sources.store import (
    ModelStore,
    append_history,
    discard,
    export_params,
    materialize,
    read_history,
    scratch_path,
    workspace,
)

__all__ = [
    "ModelStore",
    "append_history",
    "discard",
    "export_params",
    "extract_labels",
    "features_from_columns",
    "features_from_vectors",
    "inline_values",
    "materialize",
    "read_biases",
    "read_features",
    "read_history",
    "read_labels",
    "read_params",
    "read_table",
    "read_weight_rows",
    "scratch_path",
    "workspace",
]
