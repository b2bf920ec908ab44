"""eventide: event analytics on Spark DataFrames and Structured Streaming.

Windows (tumbling, sliding, session, count-triggered), net-change and
best-window reports, rolling per-key state, itemizing and routing of events,
text and multi-route sinks, checkpointed streams.  See README.md.
"""

import sys

__version__ = "0.1.0"

# Functions and classes of this package that run on executors (Arrow batch
# maps, stateful processors) are shipped by value, so executors need only
# pyspark, pandas, numpy and pyarrow, not this package on their path.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark: install the package on executors
    pass
