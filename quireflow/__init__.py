"""quireflow: a Spark-first bibliography engine and training-data toolbox."""
