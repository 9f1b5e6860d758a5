"""Query cases by family; importing this package fills the registry."""

from millrace.plans.registry import CASES, Case, Tables, case

__all__ = ["CASES", "Case", "Tables", "case"]
