"""variloom: DataFrame operators for paired tumor/normal sequencing cohorts on Spark."""

__version__ = "0.1.0"
