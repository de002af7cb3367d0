"""Incremental landing of raw feed files with Structured Streaming.

The engine's models are batch transformations over landed feeds (late data is
handled by rebuilding, as the marts are full rebuilds). What arrives over time
are feed files; ``land_stream`` appends each new file's rows, still as text,
to the Parquet landing zone exactly once, using a file-source stream with a
checkpoint in shared storage.
"""

from staylens.streaming.landing import land_stream  # noqa: F401
