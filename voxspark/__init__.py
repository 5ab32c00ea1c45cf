"""voxspark: speech-corpus preparation and scoring as Spark DataFrame jobs.

Modules are plain functions ``DataFrame -> DataFrame`` and ``Column -> Column``:

* ``functions``  - Column expressions (text cleaning, word distance, formatting)
* ``sources``    - manifest, vocabulary and tar-shard readers
* ``sinks``      - manifest, corpus, shard, metadata and report writers
* ``operators``  - relational operators (index, shards, bins, joins, WER, vocab, confidence)
* ``plans``      - test views over the driver tables, query registry and oracle SQL
* ``streaming``  - Structured Streaming variants
"""

__version__ = "0.1.0"

import sys as _sys

try:  # ship UDF code by value so executors need no installed copy of the package
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass
