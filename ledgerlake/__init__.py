"""ledgerlake: a Spark-native Bronze/Silver/Gold pipeline for payment data.

Subpackages:

* ``functions``  - Column helpers (text, exact sums and ratios, timestamps)
* ``operators``  - DataFrame -> DataFrame operators (keep-first, rules, integrity, audit, rejects, places in files)
* ``sources``    - driver tables, Bronze fixtures, text files, the partitioned layer store
* ``plans``      - Silver, Gold, quality and the end-to-end run
* ``streaming``  - incremental (date-level) ingestion
"""

__version__ = "0.1.0"
