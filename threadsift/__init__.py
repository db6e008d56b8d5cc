"""Analytics over discussion text on Spark: ingest, clean, profile, de-duplicate,
sample, rank words, trend and classify.

Main entry points:

* ``threadsift.sources.readers`` / ``threadsift.sources.sinks``: reading with
  declared schemas and a quarantine; writing reports and tables.
* ``threadsift.functions.text``: Column -> Column text functions.
* ``threadsift.operators``: ``clean``, ``profile``, ``questions``, ``dedupe``,
  ``extract``, ``words``, ``trend``, ``sample``, ``classify``, ``sorting``.
* ``threadsift.streaming.streams``: the same cleaners and counts on streams.
* ``threadsift.plans``: the registered queries over the driver tables.
"""

__version__ = "0.1.0"
