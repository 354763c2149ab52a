"""Reading raw session files and reading or writing warehouse tables."""
