"""Operators for training data and for sketching huge collections."""
