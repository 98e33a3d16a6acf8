"""Distributed operators. Fitted values are small, bounded and end up as literals in the plan."""
