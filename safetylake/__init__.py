"""safetylake: a Spark-native engine for regulatory safety data.

Nested JSON records about products, recalls and adverse-event reports are
landed, cleaned, validated, deduplicated, expanded into drug x reaction
pairs and published as keyed summary tables, which then answer KPI, top-N
and search questions and feed a keyed change stream.

Every stage is a function ``DataFrame -> DataFrame`` built from Spark's own
operators, so Catalyst sees one logical plan from scan to result.
"""

__version__ = "0.1.0"
