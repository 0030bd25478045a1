"""Training-data operators for language-model corpora (nothing else in the library imports this)."""
