"""corpusmill: curation of large text and source-code corpora on Spark DataFrames."""
