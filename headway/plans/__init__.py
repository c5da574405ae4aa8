"""Compositions of operators: silver job, marts, reports, driver-table inputs."""
