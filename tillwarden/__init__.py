"""Sales-audit processing for till logs, built on Spark DataFrames.

Till-log records (one nested record per transaction) are read, conformed into
the canonical ``sa_*`` tables, audited, reconciled and reported, in batch and
as a stream.  Every public function takes and returns DataFrames.
"""

__version__ = "0.1.0"
