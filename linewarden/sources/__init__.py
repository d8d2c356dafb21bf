"""Table readers, writers and configuration loading."""
