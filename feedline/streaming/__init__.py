"""feedline.streaming."""
