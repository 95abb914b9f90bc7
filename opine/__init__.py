"""opine: sentiment analysis of text at scale, written as Spark jobs."""
