"""Plans, configuration and external providers."""
