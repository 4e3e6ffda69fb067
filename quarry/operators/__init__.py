"""DataFrame operators: tokens and positions, index build and merge, boolean search, link rules,
TF-IDF and clustering, and text rendering."""
