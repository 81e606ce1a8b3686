"""Launch-time outcome prediction as Spark jobs: cohorts, features, models, tests."""
