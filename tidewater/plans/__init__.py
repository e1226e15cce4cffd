"""Stand-in datasets over the driver tables, the four flows and the query registry."""
