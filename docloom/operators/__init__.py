"""Document operators: requests, nested paths, chains, flattening, loads."""
