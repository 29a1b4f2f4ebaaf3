"""End-to-end plans: one building, a group of buildings with its portal graph, and the campus road graph."""
