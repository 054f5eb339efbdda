"""casefile: evidence marts from independent public-record tables, on Spark DataFrames."""

from casefile.settings import Settings

__all__ = ["Settings"]
