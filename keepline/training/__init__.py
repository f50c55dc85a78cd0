"""Fits without one fold each, side by side: every round of all of them is one pass over the rows."""
