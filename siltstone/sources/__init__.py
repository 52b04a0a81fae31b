"""Reading feeds and tables, and writing layers."""
