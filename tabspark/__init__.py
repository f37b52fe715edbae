"""tabspark: profiling, generation, validation and comparison of tables on Spark."""

__version__ = "0.1.0"
