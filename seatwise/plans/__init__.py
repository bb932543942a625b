"""The jobs: operators chained from input tables to results."""
