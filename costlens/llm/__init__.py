"""Training-data operators: thirteen corpus operators, each in its own module.

Nothing else in the library imports this subpackage; ``queries`` registers one
query per operator over the shared tables.
"""
