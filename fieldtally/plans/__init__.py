from fieldtally.plans.oracles import oracle_sql
from fieldtally.plans.queries import queries

__all__ = ["oracle_sql", "queries"]
