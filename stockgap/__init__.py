"""Stock-integrity analytics on Spark DataFrames.

Daily stock ledger per distributor and product, three fraud detectors over
it (month-end channel stuffing, promotion hoard-and-dump, bulk route
dumping), a fused risk score, report extracts and data-quality jobs.
"""

__version__ = "0.1.0"
