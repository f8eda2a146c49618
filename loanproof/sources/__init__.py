"""Reading application tables and writing reports."""
