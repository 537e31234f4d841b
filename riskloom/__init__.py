"""riskloom: supervised risk scoring and feature analytics on Spark DataFrames."""

from riskloom.spec import FeatureSpec

__all__ = ["FeatureSpec"]
