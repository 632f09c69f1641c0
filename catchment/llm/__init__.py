"""Training-data operators: each module holds one operator with its general
interface; ``queries`` registers the thin ``opN_<name>`` queries on top.

Nothing outside this package imports it.
"""
