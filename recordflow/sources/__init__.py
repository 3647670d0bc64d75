"""Reading landed files and writing results."""
