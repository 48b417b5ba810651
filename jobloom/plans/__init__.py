"""Plans: whole flows, and the registered queries that exercise every operator on the given tables."""


def load_queries():
    """(queries, SQL twins)."""
    from importlib import import_module

    from jobloom.plans.registry import ORACLE, QUERIES

    for part in ("rows", "keys", "text", "classes", "sources"):
        import_module(f"jobloom.plans.queries_{part}")
    return dict(QUERIES), dict(ORACLE)
