"""Sources: discovery, validation and reading."""
