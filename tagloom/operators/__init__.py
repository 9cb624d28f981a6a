"""Operators: DataFrame in, DataFrame out.

Jobs run only in ML fits and in the size checks that come before a broadcast.
"""
