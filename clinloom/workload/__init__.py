"""The registered queries, each beside the SQL that must give the same rows.

The given tables stand in for clinical data: an order is an encounter, its
lines are claim items, customers are patients, nations hospitals, parts
conditions and medications.
"""
