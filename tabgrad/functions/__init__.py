"""Column expressions; everything here stays inside the JVM."""

from tabgrad.functions.arrays import (
    argmax_array,
    dense_forward,
    densify,
    dot_product,
    relu_column,
    softmax_array,
)
from tabgrad.functions.seeded import order_key, permuted, permuted_from, seeded_uniform

__all__ = [
    "argmax_array",
    "dense_forward",
    "densify",
    "dot_product",
    "order_key",
    "permuted",
    "permuted_from",
    "relu_column",
    "seeded_uniform",
    "softmax_array",
]
