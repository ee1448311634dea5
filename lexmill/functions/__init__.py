"""Column functions: text, extraction, ontology, chunks, vectors."""
