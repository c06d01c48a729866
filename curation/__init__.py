"""Content curation on Spark: canonical URLs, page extraction, scoring,
dedupe, exact budget selection, feeds, lint and streaming feed state."""

from __future__ import annotations

import sys as _sys

try:  # Ship the package's Python functions (UDF bodies) with each task,
    # so executors need no install of this package.
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
