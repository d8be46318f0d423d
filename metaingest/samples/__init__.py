"""The engine's operators run over star-schema tables, with SQL to compare."""
