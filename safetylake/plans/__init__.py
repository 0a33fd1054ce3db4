"""Plans: the registered query catalog, the dataset registry and pipeline run, dashboard responses."""
