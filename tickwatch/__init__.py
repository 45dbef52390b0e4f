"""tickwatch: a market-tick anomaly engine on PySpark.

Sub-packages: ``sources`` (scans and sinks), ``operators`` (DataFrame ->
DataFrame operators), ``functions`` (column helpers), ``plans`` (transform,
reports, jobs, registered check queries) and ``streaming``.
"""

__version__ = "0.1.0"
