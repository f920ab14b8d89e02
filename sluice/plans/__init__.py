from sluice.plans.contract import Contract, Field

__all__ = ["Contract", "Field"]
