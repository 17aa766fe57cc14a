"""Multi-operator jobs: star schema build, stage jobs, read queries, reports and exports."""
