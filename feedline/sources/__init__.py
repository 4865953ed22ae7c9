"""feedline.sources."""
