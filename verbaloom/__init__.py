"""Text corpora to tokens, token vectors and nearest words, as Spark DataFrame jobs."""
