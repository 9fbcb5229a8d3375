"""Reading event tables and dimensions, and writing metric history."""
