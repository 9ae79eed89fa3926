"""tidemark: e-commerce clickstream analytics on Spark DataFrames and Structured Streaming.

Layers: raw messages (Kafka contract) -> bronze (decoded) -> silver (validated,
deduplicated) -> gold (windowed product metrics) -> keyed merge for export.
Every transform is a ``DataFrame -> DataFrame`` function with no action inside,
usable on batch and streaming input alike.
"""

__version__ = "0.1.0"
