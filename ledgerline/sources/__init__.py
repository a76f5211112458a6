"""Table sources: the logical-table binding and the Tables container."""
