"""vitrine: collection-management analytics as PySpark DataFrame operations.

Normalised record, list and relation tables go in; wide records with
multi-valued fields, hierarchy closures, range reports, statistics and bulk
changes come out.  Everything is a lazy DataFrame plan.
"""
