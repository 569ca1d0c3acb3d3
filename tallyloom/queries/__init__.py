from tallyloom.queries import catalogue, changes, changes_sql, oracle

QUERIES = catalogue.QUERIES | changes.QUERIES
ORACLE = oracle.ORACLE | changes_sql.ORACLE

__all__ = ["ORACLE", "QUERIES"]
