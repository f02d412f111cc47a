"""changeflow: Spark-native analytics over streams of change events.

Layers: raw envelope (bronze) -> typed, deduplicated rows (silver) ->
windowed aggregates (gold), plus batch serving, integrity, late-data and
source-profile jobs. Every operator is a DataFrame -> DataFrame function
that works on batch and streaming frames alike where Spark allows it.
"""

__version__ = "0.1.0"
