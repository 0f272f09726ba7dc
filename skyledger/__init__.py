"""skyledger: flight-segment feed analytics on Spark DataFrames.

Feed lines (files, a topic, or the ``events`` stand-in) are parsed into a
typed 21-field table with bad lines set aside, then aggregated per replay
batch: the agency or agencies with most flight segments, and speed
statistics for one agency (optionally one flight).  The same operators run
in batch jobs and inside Structured Streaming ``foreachBatch``.
"""

__version__ = "0.1.0"
