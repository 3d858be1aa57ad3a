"""contrail: flight-operations analytics expressed as lazy Spark DataFrame plans.

Every public operator takes DataFrames plus plain parameters and returns a
DataFrame; nothing is collected to the driver except one-row scalars that a
plan needs (and those are bounded by construction).

Sub-packages
------------
sources    readers, writers, contracts, the driver-table binding, run log
operators  profiling, schema contracts, cleaning, modelling, data quality
functions  scalar column helpers and the distributed ranking primitive
plans      the analytical query catalogue (metrics, KPIs, distributions)
"""

from contrail.spec import FactSpec, Star, Tables, FLIGHT_SPEC  # noqa: F401
