"""Reading source files and keeping versioned tables."""
