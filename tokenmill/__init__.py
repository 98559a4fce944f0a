"""tokenmill — Spark-native data preparation and evaluation for language-model work.

Subpackages: ``sources`` (scans, sinks), ``functions`` (Column functions),
``operators`` (DataFrame -> DataFrame operators), ``plans`` (composed jobs
and the registered query catalogue), ``streaming`` (Structured Streaming).
"""

__version__ = "0.1.0"
