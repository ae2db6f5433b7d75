from .hashing import unit_hash, unit_hash_sql
from .tenure import register_functions, tenure_days

__all__ = ["unit_hash", "unit_hash_sql", "register_functions", "tenure_days"]
