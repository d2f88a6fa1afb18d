"""The same operators as plain SQL over relations, for checking the Spark results.

Written row by row (lines, self joins, ranking) where the Spark code works on arrays in place, so the
two share the inputs and the word lists but not the method.
"""
