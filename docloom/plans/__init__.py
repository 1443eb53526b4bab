"""Query plans: resources, registered queries, views and their SQL oracles."""
