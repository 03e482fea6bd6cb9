"""Operators for preparing language-model training data.

Nothing outside this folder imports it; it may use the general helpers of the
library (sessions, scratch tables). Each module is one operator; ``queries`` lists
the registered queries and ``oracle`` their SQL twins.
"""
