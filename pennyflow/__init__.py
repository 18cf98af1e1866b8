"""Event and payment analytics on Spark: metrics, funnels, fraud rules, cohorts, offer targeting."""
