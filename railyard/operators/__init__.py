"""DataFrame -> DataFrame operators.

conform (B1, B2, F1) · quality (C7, E8, D9, K2) · keys (K1) · lookup (C1-C5,
D1-D10) · scd (J1, J3, J7, F3) · calendar (J5, J6) · aggregates (E1-E9, F2,
G2).
"""
