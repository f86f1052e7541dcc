"""Jobs: operators and sources chained into what a user schedules."""
