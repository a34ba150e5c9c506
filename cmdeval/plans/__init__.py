from .catalog import QUERIES, flagship
from .oracle import ORACLE_SQL

__all__ = ["QUERIES", "ORACLE_SQL", "flagship"]
