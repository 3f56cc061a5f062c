"""Query plans: star joins, reports, parameters and dependent models."""
