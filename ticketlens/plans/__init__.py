"""Plans: star-schema build, reports, dashboard panels and the registered query catalog."""
