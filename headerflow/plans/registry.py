"""All queries of the engine and the SQL that says what each must return."""

from .queries import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
