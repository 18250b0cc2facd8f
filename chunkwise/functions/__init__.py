"""Column -> Column functions (JVM-side, no Python on the data path)."""

from chunkwise.functions.text import (WHITESPACE, chunk_key, fmt2, preview, words)
from chunkwise.functions.vectors import (cosine_distance, cosine_similarity, dot,
                                         l2_norm, l2sq_distance, to_double_vector)

__all__ = [
    "WHITESPACE", "chunk_key", "fmt2", "preview", "words",
    "cosine_distance", "cosine_similarity", "dot", "l2_norm", "l2sq_distance",
    "to_double_vector",
]
