"""DataFrame operators: hierarchy resolution, road matching, fallback sampling, results."""
