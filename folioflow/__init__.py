"""Document analytics on Spark: cleaning, validation, keyphrases, labels, contexts, summaries, artifacts and metrics."""
