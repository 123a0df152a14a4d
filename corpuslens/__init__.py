"""Labelled-text analytics on Spark: cleaning, statistics, language models, evaluation."""
