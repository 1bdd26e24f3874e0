"""Rows of a table as dictionaries. A module of its own: conftest is a name that several folders have."""


def rows(df):
    return [row.asDict() for row in df.collect()]
