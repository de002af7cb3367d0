"""staylens: lodging KPIs (occupancy, net revenue, ADR) on Spark DataFrames.

Raw reservation feeds from several property-management systems are read as
text, normalised onto one reservation contract, deduplicated to the latest
valid snapshot, expanded to nights and aggregated per hotel and night. Every
step is a function ``DataFrame -> DataFrame`` built from Spark expressions, so
Catalyst sees one plan from the raw scan to the served report.
"""

__version__ = "0.1.0"
