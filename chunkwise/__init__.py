"""chunkwise: document retrieval (chunk, embed, store, search, prompt) as Spark jobs.

Every operator is a DataFrame -> DataFrame (or Column -> Column) function that
plans through Catalyst; the only Python on the data path is the pluggable
encoder / language-model client and the Arrow-batched distance kernel.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Ship this package's functions to Python workers by value, so executors need
# no installed copy (a cluster may still use --py-files; both work).
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from chunkwise.session import get_session, scratch_dir, scratch_path  # noqa: E402

__all__ = ["get_session", "scratch_dir", "scratch_path"]
