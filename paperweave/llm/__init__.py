"""Operations of a training-data pipeline, one module per operator.

Nothing outside this subpackage imports it; ``queries.py`` registers one query
per operator and ``oracle.py`` holds the SQL that checks them.
"""
