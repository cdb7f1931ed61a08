"""framelake: table operators for video-frame detection analytics on Spark.

Every operator takes and returns DataFrames; only ``framelake.sinks`` writes.
"""

__version__ = "0.1.0"
