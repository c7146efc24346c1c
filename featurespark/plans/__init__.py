"""End-to-end reports, input views over the test tables, and the query registry."""
