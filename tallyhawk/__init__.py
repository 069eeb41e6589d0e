"""tallyhawk: a Spark-native SCD2 warehouse and card-fraud report.

Daily loads (fact append, snapshot refresh, type-2 history for four
dimensions with watermarked incremental staging and delete detection)
and four fraud rules, all expressed as DataFrame transformations.
"""

from tallyhawk.schemas import OPEN_END, REFERENCE, STRICT

__all__ = ["OPEN_END", "REFERENCE", "STRICT"]
