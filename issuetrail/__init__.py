"""Issue-resolution analytics over software-project event archives, on Spark DataFrames."""

from issuetrail.params import Params

__all__ = ["Params"]
