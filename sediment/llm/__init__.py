"""Operators for building training data at scale, their registered queries and the SQL of those."""
