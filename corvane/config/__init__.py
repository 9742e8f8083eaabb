"""Domain vocabulary: lists and rule tables, kept apart from the operators."""
