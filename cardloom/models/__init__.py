"""Scaling, out-of-fold training, selection, stacking and blending."""
