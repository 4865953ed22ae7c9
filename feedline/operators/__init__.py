"""feedline.operators."""
