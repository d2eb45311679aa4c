"""Model graph, declared checks, gated refresh and the registered queries with oracle SQL."""
