"""Station tap analytics on Spark: slots, features, rule and model forecasts."""
