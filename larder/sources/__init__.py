"""Reading the raw tables, writing result tables, and procurement data shaped from test tables."""
