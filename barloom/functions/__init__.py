"""Part of barloom."""
