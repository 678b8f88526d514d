"""vantage: account-health metric engine on Spark DataFrames.

Raw customer-success tables -> month-end account scores (five components,
band, expansion flag) -> rep rollups, report queries and data-quality checks.
"""

__version__ = "0.1.0"
