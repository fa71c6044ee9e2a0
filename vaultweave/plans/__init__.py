from vaultweave.plans.specs import DWL, FP

__all__ = ["DWL", "FP"]
