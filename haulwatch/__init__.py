"""Fleet analytics on Spark: GPS decoding, enrichment, trips, alarms, tonnage and scores."""
