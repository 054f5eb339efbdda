"""Compositions: reports, the independent baseline and the whole build."""
