"""How the operators are exercised on the given tables: adapters, queries, oracles."""
