from dimsmith.operators import constraints, loyalty, merge, scd, star

__all__ = ["constraints", "loyalty", "merge", "scd", "star"]
