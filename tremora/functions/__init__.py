"""Column expressions: no joins, no actions, all inside Catalyst."""
