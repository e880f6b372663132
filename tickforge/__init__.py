"""tickforge: price-tick analytics as Spark DataFrame transformations.

Ticks -> row features / windowed technical indicators -> rule and model
signals -> per symbol x signal backtests -> serving queries, in batch and
(for the tick-to-signal chain) in Structured Streaming.
"""

__version__ = "0.1.0"
