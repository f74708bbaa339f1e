"""Plan-shape helpers: bounded broadcast, variant agreement and plan checks."""
