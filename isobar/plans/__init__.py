"""Tables and jobs built from the operators: gold, charts, maps, quality checks, jobs."""
