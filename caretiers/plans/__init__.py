"""Complete models: silver, gold, and the run from landing to mart."""
