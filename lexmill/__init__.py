"""Document curation and corpus analytics expressed as Spark plans."""
