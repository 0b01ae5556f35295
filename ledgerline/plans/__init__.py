"""Compositions of the operators into the lakehouse layers."""

from ledgerline.plans.lakehouse import Lakehouse

__all__ = ["Lakehouse"]
