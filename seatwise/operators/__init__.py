"""Pure DataFrame operators: tables in, table out, no side effects."""
