"""Column functions: text, URLs, times, codes and scores."""
