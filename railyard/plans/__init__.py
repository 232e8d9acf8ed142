"""Composed jobs: dims (J1-J7), facts (J8-J10), mart (J11), batch (J12, A11,
mart run), the TESTDATA role mapping (fixtures) and the registered queries
(queries_*, registry, memo)."""
