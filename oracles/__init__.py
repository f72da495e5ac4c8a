"""DuckDB SQL of the oracles: the fixture tables and the KPI expressions."""
