"""roasline: campaign-performance analytics as lazy Spark DataFrame operators.

Layers
------
functions/  column-expression helpers (safe division, lenient parsing, number text)
sources/    CSV discovery and scans, table sinks, read-back contracts, fixture exports
operators/  normalise, audit, features, model, scoring, roll-up, scenarios, insights
plans/      end-to-end jobs composed from the operators, and the query registry
streaming/  the normalisation operators applied to a file stream of daily exports
"""

__version__ = "0.1.0"
