from vaultweave.operators.hub import hub_rows
from vaultweave.operators.link import link_rows
from vaultweave.operators.mart import traffic_mart
from vaultweave.operators.ods import ods_load
from vaultweave.operators.satellite import latest_hashdiffs, sat_rows
from vaultweave.operators.staging import stage

__all__ = ["stage", "hub_rows", "link_rows", "sat_rows", "latest_hashdiffs",
           "ods_load", "traffic_mart"]
