"""Operations of a pipeline that prepares training text.

Each module holds one operator; ``queries`` registers them over the supplied
tables.  Nothing else in the library imports this package.
"""
