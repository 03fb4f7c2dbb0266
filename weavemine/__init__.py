"""weavemine: DataFrame-native analytics for semi-structured model corpora."""
