"""Plans: the report, the end-to-end pipeline, registered queries and their SQL oracles."""
