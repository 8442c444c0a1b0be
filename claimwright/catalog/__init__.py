from . import features, models, profiles, tables

PARTS = (tables, profiles, features, models)


def all_queries():
    return {name: query for part in PARTS for name, query in part.catalog.queries.items()}


def all_oracles():
    return {name: sql for part in PARTS for name, sql in part.catalog.oracles.items()}
