"""Tables of slides, tiles, coverage, folds, vectors and predictions as Spark jobs."""
