"""tickwatch: anomaly detection over keyed, time-ordered tick streams on Spark."""

__version__ = "0.1.0"
