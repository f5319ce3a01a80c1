"""Layer transformations: pure, lazy DataFrame -> DataFrame functions."""
