"""Reading landed files and writing warehouse tables."""
