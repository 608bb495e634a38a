from tickloom.plans.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
