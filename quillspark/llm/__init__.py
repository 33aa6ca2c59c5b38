"""Training-data pipeline operators: tokenising, decontamination, language ID, near-duplicates, personal data,
toxicity, secrets and sharding, each a Spark job over whole tables. Nothing else in the package imports this."""
