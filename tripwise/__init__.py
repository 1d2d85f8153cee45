"""tripwise: driving-telemetry feature and risk-scoring jobs on Spark DataFrames.

Layout
------
sources/    telemetry scan, cleaning, train/test union, test-table adapter, sinks
functions/  column expressions (great-circle distance, local time parts)
operators/  feature blocks and the fused trip -> driver assembler, selection,
            splits, k-NN, models, ensembles, metrics
plans/      end-to-end submission jobs built from the operators
streaming/  incremental ingest of telemetry files with Structured Streaming
"""

from tripwise.config import FeatureConfig

__all__ = ["FeatureConfig"]
