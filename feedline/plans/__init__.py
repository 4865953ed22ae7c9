"""feedline.plans."""
