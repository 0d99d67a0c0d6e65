"""factloom: Spark jobs for document corpora whose answers must trace back to a source."""
