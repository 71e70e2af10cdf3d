"""DataFrame operators on cell tables and series."""
