"""Business plans (ledger fact, control statements, landing) and the
registered queries with their DuckDB oracles."""
