"""DuckDB statements equal to each report, used as the correctness oracle."""
