"""Operators for building training data. Nothing outside this subpackage imports it."""


def queries():
    from . import registry as registered

    return registered.queries()


def oracle_sql():
    from . import registry as registered

    return registered.oracle_sql()
