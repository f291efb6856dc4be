"""aerolake: a PySpark-native lakehouse for airline flight-operations data.

Layers: bronze (raw text rows, all STRING, with file lineage) -> silver
(typed, calendar parts, flight status, route key, airport enrichment) ->
gold (punctuality, volume by period, route ranking) + data-quality checks.
"""

__version__ = "0.1.0"
