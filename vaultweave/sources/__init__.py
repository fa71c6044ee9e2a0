from vaultweave.sources.fixtures import ods_source, stg_source, table
from vaultweave.sources.store import TableStore

__all__ = ["table", "ods_source", "stg_source", "TableStore"]
